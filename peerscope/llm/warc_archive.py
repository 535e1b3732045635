"""Content-addressed WARC archive.

``write_archive`` stores one record per page in two tables of a folder that
all executors share:

* ``payloads``: (digest, payload), every distinct payload once, by SHA-256;
* ``headers``: (digest, header), the exact header block of every record.

Of records with equal payloads of at least ``min_bytes`` bytes the one with
the smallest page id is a response and the others are revisits that refer to
it; shorter payloads are all responses (their bytes are stored once as well).
``read_archive`` checks every stored payload against its digest, parses the
headers and joins them to the payloads, which gives back every record.
``export_warc`` writes plain WARC files.

Scale: payloads are combined map-side before their one exchange; headers are
narrow rows, and their equi-joins on the digest may be split by AQE.  The
digest is a function of the row alone, so lost tasks repeat exactly.

Defined results: null html is an empty payload; a null page id sorts last (if
all are null, all are responses); pages that share the smallest id are all
responses; a null url is an empty target; control characters and blanks in an
url are percent-encoded in the header.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"


def _target(url: Column) -> Column:
    """The url with the bytes that would end a header line percent-encoded."""
    out = F.coalesce(url, F.lit(""))
    for c in "\r\n\t ":
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def _header(date: str) -> Column:
    is_revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", page("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _target(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(is_revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.when(is_revisit, line("WARC-Refers-To", page("refers_to"))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(is_revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z"
) -> None:
    spark = pages.sparkSession
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_id")).write.parquet(f"{path}/payloads")
    firsts = spark.read.parquet(f"{path}/payloads").select("digest", "first_id")
    refers = (F.col("bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    heads = rows.select("page_id", "url", "digest", F.length("payload").alias("bytes")).join(firsts, "digest")
    heads.withColumn("refers_to", F.when(refers, F.col("first_id"))).select("digest", _header(date).alias("header")).write.parquet(f"{path}/headers")


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)


def _page(name: str) -> Column:
    return F.regexp_extract("header", rf"(?:^|\n){name}: <urn:page:(-?[0-9]+)>\r\n", 1).try_cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, header, payload) per record.

    Fails if a stored payload does not have the digest that it is stored under.
    """
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest")).cast("binary"))
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", checked.alias("payload"))
    heads = spark.read.parquet(f"{path}/headers").select("header").withColumn("digest", _field("WARC-Payload-Digest").substr(F.lit(8), F.lit(64)))
    return heads.join(payloads, "digest").select(
        _page("WARC-Record-ID").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _page("WARC-Refers-To").alias("refers_to"),
        F.col("digest").alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_bytes"),
        "header",
        "payload",
    )


def export_warc(records: DataFrame, path: str, records_per_file: int = 10_000) -> None:
    """Plain WARC files of the records of ``read_archive``: header, block (none for revisits), two line ends."""
    block = F.when(F.col("record_type") == "revisit", "").otherwise(F.col("payload").cast("string"))
    whole = records.select(F.concat("header", block).alias("value"))
    whole.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records_per_file).text(path)
