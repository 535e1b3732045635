"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "peerscope", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; it must
    be set, since a folder of one machine would not be seen by the others.
    Only a ``local`` master (tests) gets a private folder when it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        if sc is None or not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="peerscope-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no local context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/peerscope/{name}-{uuid.uuid4().hex}"


def session_key(spark: SparkSession) -> str:
    """Identity of a running application (unlike ``id(spark)``, never reused
    by a later session in the same Python process)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or f"session-{spark.sessionId if hasattr(spark, 'sessionId') else id(spark)}"


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # pragma: no cover - unusual config values
        return int(os.environ.get("PEERSCOPE_PARTITIONS", "200"))
