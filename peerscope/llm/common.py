"""Helpers shared by the operators: table access and lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and reread.

    Cuts the lineage and lets later readers prune columns; the folder is the
    one ``spark.checkpoint.dir`` names, so a lost executor costs no rerun.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with as many underscores before it as make it a new column name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


#: Most keys (a few longs each, so some MB) that are broadcast; beyond it the join is shuffled.
BROADCAST_KEYS = 500_000


def small_enough(keys: DataFrame, n: int | None = None) -> DataFrame:
    """``keys`` (already written) with a broadcast hint if they are at most BROADCAST_KEYS; ``n`` counts them if rows hold lists."""
    return F.broadcast(keys) if (keys.count() if n is None else n) <= BROADCAST_KEYS else keys


def keyed_rows(docs: DataFrame, keys: DataFrame, *, keep: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id (and ``text_hash``, if ``keys`` has it) is among ``keys``, or is not."""
    names = {c: f"_key_{c}" for c in ("doc_id", "text_hash") if c in keys.columns}
    k = small_enough(saved(keys.select(*(F.col(c).alias(n) for c, n in names.items())).distinct(), "keys"))
    on = docs[id_col].cast("long").eqNullSafe(k["_key_doc_id"])
    if "text_hash" in names:
        on = on & F.xxhash64(docs[text_col].cast("string")).eqNullSafe(k["_key_text_hash"])
    return docs.join(k, on, "left_semi" if keep else "left_anti")
