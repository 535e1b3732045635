"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. quality rules (operator 5): rejected documents go;
2. line dedup (7): repeated lines are cut, documents left without a line go;
3. n-gram Jaccard join (3) on five-word shingles at 0.8: of each group of
   linked documents the one with the smallest id stays;
4. benchmark decontamination (4): documents with a leak go;
5. BPE encoding and decoding (2): packed ids, their number, and the decoded text.

Rows that share an id are judged one by one (by id and text) in stages 1, 3
and 4; stage 3 keeps every linked row of the id that stays.  A null id is an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm import bpe, decontaminate, line_dedup, ngram_jaccard, quality_rules
from peerscope.llm.common import keyed_rows, saved, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rejected = quality_rules.judge(docs, table(spark, sf_dir, "labels"), with_hash=True).filter("not kept")
    return keyed_rows(docs, rejected.select("doc_id", "text_hash"), keep=False)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs, short=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.link_components(docs, ngram_jaccard.Threshold(80, 100, 5), with_hash=True)
    return keyed_rows(docs, found.filter("not doc_id <=> component_id").select("doc_id", "text_hash"), keep=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), with_hash=True)
    return keyed_rows(docs, leaks.select("doc_id", "text_hash"), keep=False)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs).withColumn("n_tokens", F.expr("cast(length(ids) div 4 as bigint)"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: No SQL for hashed likelihood ratios, edit joins, templates and BPE; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
