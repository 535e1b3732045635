import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from peerscope.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[2]")
        .appName("peerscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="peerscope-test-ckpt-"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", "file:" + tempfile.mkdtemp(prefix="peerscope-test-events-"))
        .config("spark.eventLog.buffer.kb", "1k")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="peerscope-test-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="peerscope-test-")
