"""Quality rules: word statistics and a hashed n-gram log-likelihood ratio [DataFrame operations only].

Words are ``[^\\x20\\x09-\\x0D]+``.  Every word and every pair of neighbouring
words is hashed to one of ``buckets`` buckets.  Two smoothed multinomials are
counted over them: the trusted target (texts labelled good, at most
``trusted_docs`` of them, those with the smallest hash of their id) and the
raw corpus (all texts, scaled to the target's size); both get ``prior`` counts
more in each bucket, so that rare n-grams say little.  A text's score is the sum of log(target / raw) over
its n-grams divided by their number; it is kept if the score reaches
``threshold`` and it passes the base rules.

Scale: counting is one aggregate with map-side combining (at most one row per
bucket and task is shuffled); scoring joins the exploded n-grams to the model,
which has ``buckets`` rows whatever the input, and adds up per text before the
shuffle.  Ratios are whole millionths, so sums do not depend on the order.

Defined results: a null text has no words and fails the base rules; without
any trusted text all scores are 0; a text without n-grams scores 0; repeated
rows give repeated results; null labels are ignored and an id counts as
trusted if any of its labels is good; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved

_SPACE = "[\\x20\\x09-\\x0D]+"
SCALE = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda x: x != "")


def _threes(f) -> Column:
    """``f`` of the three words of each window of ``words``, of which there are ``n``."""
    at = lambda k: F.slice("words", F.lit(k), F.greatest(F.col("n") - 2, F.lit(0)))
    pairs = F.zip_with(at(1), at(2), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(pairs, at(3), lambda p, c: f(p["a"], p["b"], c))


def _repeated_words() -> Column:
    """Words covered by the 3-word windows that occur twice or more.  Sorted by hash and then by text, so equal ones are neighbours."""
    windows = _threes(lambda a, b, c: F.concat(a, F.lit(" "), b, F.lit(" "), c))
    by_text = F.sort_array(F.transform(windows, lambda x, i: F.struct(F.xxhash64(x).alias("h"), x.alias("x"), i.alias("i"))))
    again = lambda s: F.transform(s, lambda e, k: F.when((F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"]), e["i"]))
    starts = F.transform(F.array(by_text), lambda s: F.sort_array(F.filter(again(s), lambda i: i.isNotNull())))[0]
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).cast("long").alias("n"), (i + 3).alias("end"))
    return F.aggregate(starts, zero, step, lambda a: a["n"])


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]")))
    rows = rows.withColumns({"lines": lines, "n": F.size("words")})
    # windows with distinct hashes are distinct; only texts with equal hashes are looked at closely
    rows = rows.withColumn("hashes", _threes(lambda a, b, c: F.xxhash64(a, b, c)))
    repeated = F.when(F.size(F.array_distinct("hashes")) == F.size("hashes"), F.lit(0).cast("long")).otherwise(_repeated_words())
    rows = rows.select(
        "doc_id",
        "text_hash",
        "words",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
    )
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def bucket_pairs(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` by word: its bucket ``one``, and ``two``, that of it and the next word (null at the end); one null row without words."""
    rows = rows.select(*(c for c in rows.columns if c != "words"), "words", F.posexplode_outer("words").alias("place", "word"))
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")
    after = F.get("words", F.col("place") + 1)
    out = {"one": F.when(F.col("word").isNotNull(), bucket("word")), "two": F.when(after.isNotNull(), bucket(F.col("word"), after))}
    return rows.withColumns(out).drop("words", "place", "word")


def trusted_ids(labels: DataFrame, trusted_docs: int) -> DataFrame:
    """At most ``trusted_docs`` ids labelled good: those with the smallest hash."""
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_docs)


def likelihood_model(docs: DataFrame, labels: DataFrame, *, buckets: int, trusted_docs: int, prior: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ratio): log(target / raw) in millionths, one row for each bucket."""
    trusted = F.broadcast(trusted_ids(labels, trusted_docs).withColumn("trusted", F.lit(1)))  # bounded by trusted_docs
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), words(docs[text_col].cast("string")).alias("words"))
    rows = bucket_pairs(rows.join(trusted, "doc_id", "left").select(F.coalesce("trusted", F.lit(0)).alias("trusted"), "words"), buckets)
    grams = rows.select("trusted", F.explode(F.array("one", "two")).alias("bucket")).filter("bucket is not null")
    counts = saved(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")), "quality-counts")
    totals = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    spark = docs.sparkSession
    scale = totals["target"] / totals["raw"] if totals["target"] else 0.0  # the raw counts that a text sample of the target's size would have
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    ratio = F.log((count("target") + prior) / (count("raw") * scale + prior)) if scale else F.lit(0.0)
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    return every.select("bucket", F.round(ratio * SCALE).cast("long").alias("ratio"))



def judge(
    docs: DataFrame, labels: DataFrame, *, buckets: int = 65_536, trusted_docs: int = 20_000, prior: float = 20.0, threshold: float = -0.1, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False
) -> DataFrame:
    """One row per row of ``docs``: the base statistics, ``score`` (millionths per n-gram) and ``kept``.

    ``with_hash`` adds ``text_hash`` (xxhash64 of the text), which tells rows that share an id apart.
    """
    model = saved(likelihood_model(docs, labels, buckets=buckets, trusted_docs=trusted_docs, prior=prior, id_col=id_col, text_col=text_col), "quality-model")
    stats = base_statistics(docs, id_col, text_col)
    keys = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *["text_hash"] * with_hash]
    stats = stats.select(*keys, "words", F.monotonically_increasing_id().alias("row"))  # numbers rows within this one job
    scored = bucket_pairs(stats, buckets)
    for c in ("one", "two"):  # the model has `buckets` rows
        of = F.broadcast(model.select(F.col("bucket").alias(c), F.col("ratio").alias(f"ratio_{c}")))
        scored = scored.join(of, c, "left")
    total = F.coalesce(F.sum(F.coalesce("ratio_one", F.lit(0)) + F.coalesce("ratio_two", F.lit(0))), F.lit(0))
    # the statistics are functions of the row, so they ride along as values and not as keys
    out = scored.groupBy("row").agg(*(F.max(k).alias(k) for k in keys), total.alias("total"), (F.count("one") + F.count("two")).alias("n_grams"))
    score = F.when(F.col("n_grams") > 0, F.col("total") / F.col("n_grams")).otherwise(F.lit(0.0))
    return out.withColumn("score", score).select(*keys, "score", (~F.col("base_failed") & (F.col("score") >= threshold * SCALE)).alias("kept"))
