"""Registered queries of the operators: thin projections of their real outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    line_dedup,
    merkle_manifest,
    ngram_jaccard,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
    warc_archive,
)
from peerscope.llm.common import table
from peerscope.session import scratch_path


# fixed values: the url rules of the contract
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_url_rules(spark: SparkSession, d: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page."""
    rules = url_filter.rules_frame(spark, URL_RULES)
    return url_filter.filter_urls(table(spark, d, "pages").select("page_id", "url"), rules).drop("url")


def op2_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Every whole text encoded and decoded; digests of the ids and of the decoded text."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs)
    return done.select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Shingle set size and link component of every whole text (3 words, similarity 0.9)."""
    return ngram_jaccard.link_components(table(spark, d, "documents"), ngram_jaccard.Threshold(90, 100, 3))


def op4_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every (document, benchmark item) leak with its span and kind."""
    return decontaminate.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    """Base statistics, likelihood-ratio score and verdict of every whole text."""
    return quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_substrings(spark: SparkSession, d: str) -> DataFrame:
    """Spans of every text that repeat an earlier ranked occurrence: whole units and passages of 50 words or more."""
    return substring_dedup.repeated_passages(table(spark, d, "documents"))


def op7_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every text that repeat an earlier ranked line, exactly or within two edits (short lines within fewer)."""
    found = line_dedup.repeated_lines(table(spark, d, "documents"), short=True)
    span = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))
    return found.select("doc_id", "n_lines", "n_exact", "n_near", F.array_join(F.transform("removed", span), ",").alias("removed"))


def op8_secrets(spark: SparkSession, d: str) -> DataFrame:
    """Counts, base digest and all spans of every whole text."""
    found = secret_scan.scan_secrets(table(spark, d, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_der", "n_jwt")


def op9_warc(spark: SparkSession, d: str) -> DataFrame:
    """Every page archived, read back and described by its reconstructed record."""
    path = scratch_path(spark, "warc")
    warc_archive.write_archive(table(spark, d, "pages"), path)
    records = warc_archive.read_archive(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Expected severity and grade of every whole text."""
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))


def op11_repair(spark: SparkSession, d: str) -> DataFrame:
    """Faults, cheapest repair and digest of every damaged conversation."""
    conversations = table(spark, d, "conversations")
    out = conversation_repair.repair(conversation_repair.damaged(conversations), ids=conversations)
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_merkle(spark: SparkSession, d: str) -> DataFrame:
    """Leaf, proof and verdict of every document; rows whose id's crc32 7 divides are checked with a tampered leaf."""
    docs = table(spark, d, "documents")
    doc_id, fields = docs["doc_id"], ["doc_id", "source", "lang", "n_chars", "text"]
    more = (docs["n_chars"].cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = merkle_manifest.leaf_digest(*[more if f == "n_chars" else docs[f] for f in fields])
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    rows = merkle_manifest.manifest(docs, fields, group_col="lang", order_col="doc_id", carry={"tampered": F.when(hit, tampered)})
    rows = rows.withColumn("folded_root", merkle_manifest.folded_root(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_shards(spark: SparkSession, d: str) -> DataFrame:
    """Every document in one of 40 shards of equal row counts, equal texts together."""
    rows = sharding.shard_rows(table(spark, d, "documents"), 40).rows
    return rows.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_bpe": op2_bpe,
    "op3_jaccard": op3_jaccard,
    "op4_leaks": op4_leaks,
    "op5_quality": op5_quality,
    "op6_substrings": op6_substrings,
    "op7_lines": op7_lines,
    "op8_secrets": op8_secrets,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_repair": op11_repair,
    "op12_merkle": op12_merkle,
    "op13_shards": op13_shards,
}
