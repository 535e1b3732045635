"""Cutting lineage with a reliable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame

from peerscope.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once, into ``spark.checkpoint.dir``.

    For a result that is read several times (a panel of places x years, the
    distinct values of a rank): the plan that built it runs once, and a lost
    executor costs a read of shared files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
