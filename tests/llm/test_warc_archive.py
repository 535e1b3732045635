import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from peerscope.llm import warc_archive as W

LONG = "<html>" + "é😀 long enough to be shared by revisits " * 4 + "</html>"
PAGES = [
    (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, None, LONG), (9, None, LONG), (1, "http://a/3", "short"), (2, "http://a/4", "short"),
    (4, "http://a/5", None), (6, "http://a/6", ""), (7, "http://x\r\nWARC-Type: revisit\r\n\r\nb c\t", LONG + "x\r\n\r\ny"), (None, "http://n", LONG),
    (None, "http://m", "only null ids have this payload " * 5), (None, "http://m", "only null ids have this payload " * 5), (-8, "u", "z" * 100), (8, "u", "z" * 100), (10, "u", "z" * 99), (11, "u", "z" * 99),
    (12, "v", "w" * 300_000),
]
SCHEMA = "page_id long, url string, html string"


def brute(rows):
    out = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and first is not None and page != first
        out[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    return out


@pytest.fixture()
def archive(spark, tmp_dir):
    pages = spark.createDataFrame([(*p, 1, "d") for p in PAGES], f"{SCHEMA}, bytes int, digest string")
    W.write_archive(pages, os.path.join(tmp_dir, "archive"))
    return os.path.join(tmp_dir, "archive")


def test_records(spark, archive):
    got = W.read_archive(spark, archive).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(PAGES)
    for r in got:
        assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and r.header.startswith("WARC/1.1\r\n") and r.header.endswith("\r\n\r\n")
    assert spark.read.parquet(f"{archive}/payloads").count() == len({(h or "") for *_, h in PAGES})


def test_damaged_payloads_are_noticed(spark, archive, tmp_dir):
    bad = os.path.join(tmp_dir, "bad")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{bad}/headers")
    spark.read.parquet(f"{archive}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        W.read_archive(spark, bad).collect()


def parsed(data):
    """(headers, block) of each record of a WARC file, by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        lines = data[at : end - 4].decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and data[end + n : end + n + 4] == b"\r\n\r\n"
        yield fields, data[end : end + n]
        at = end + n + 4


def test_exported_files(spark, archive, tmp_dir):
    out = os.path.join(tmp_dir, "warc")
    W.export_warc(W.read_archive(spark, archive), out)
    records = [x for f in sorted(os.listdir(out)) if f.endswith(".txt") for x in parsed(open(os.path.join(out, f), "rb").read())]
    assert len(records) == len(PAGES)
    for fields, block in records:
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        else:
            assert block == b"" and fields["WARC-Refers-To"].startswith("<urn:page:")


def test_no_pages(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none")
    W.write_archive(spark.createDataFrame([], SCHEMA), path)
    assert W.read_archive(spark, path).count() == 0
