"""URL rules as a sort-merge range join [DataFrame operations only].

A rule is (host, path prefix, verdict).  It fits an url whose host is the
rule's or a subdomain of it and whose path starts with the rule's path.  With
host labels reversed (``org.example.www``), the url has one key per number of
leading labels, ``labels + NUL + path``, and a rule's key is a prefix of one
of them exactly if the rule fits; so a rule covers one interval of keys, and
intervals are nested or disjoint.

The sweep: rule keys and url keys are sorted together in range partitions
("zones", written once).  The rules open at a url key are all on the stack of
the last rule at or before it (its enclosing rules and itself), so the running
last value of a rule's stack, plus the last rule of the zones before, is the
sweep's state; a key drops the entries that have closed.

Scale: only distinct (host, path) pairs are swept, so copies of an url
collapse map-side; zones cut a hot host or key by path and host; the verdicts
go back to the pages by an equi-join that AQE may split.  Url keys are bounded
by the longest rule's label count.

Defined results: a null url or one without ``://`` has an empty host and path;
rules with a null part are ignored; of rules with equal host and path a block
wins.  The longest rule string (host and path) wins; of equally long ones the
one with more host labels.  Repeated rows give repeated results; other columns
are not read.  Urls that no rule fits get ``default``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerscope.llm.common import saved
from peerscope.session import shuffle_partitions

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ENTRY = "struct<length:int,labels:int,site:string,path:string,rule:string,verdict:string>"


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows of a short list; a long list is read from a table with these columns."""
    rows = [F.struct(*(F.lit(x).cast("string").alias(n) for x, n in zip(r, ("host", "path", "verdict")))) for r in rules]
    kind = "array<struct<host:string,path:string,verdict:string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for a null url and one without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, _PARTS, i), F.lit(""))
    return lower_ascii(part(1)), part(2)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(site: Column, path: Column) -> Column:
    return F.concat(site, F.lit("\0"), path)


def stacked_rules(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule key with the rules whose keys are prefixes of it, itself included."""
    r = (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max(F.col("verdict") == "block").alias("blocks"))
        .withColumn("site", F.array_join(_labels(F.col("host")), "."))
        .select(
            _key(F.col("site"), F.col("path")).alias("key"),
            F.struct(
                F.length(F.concat("host", "path")).alias("length"),
                F.size(_labels(F.col("host"))).alias("labels"),
                "site",
                "path",
                F.concat("host", "path").alias("rule"),
                F.when(F.col("blocks"), "block").otherwise("allow").alias("verdict"),
            ).alias("entry"),
        )
    )
    prefixes = r.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select("key", F.expr("substr(key, 1, n)").alias("prefix"))
    open_at = r.select(F.col("key").alias("prefix"), "entry")
    return prefixes.join(open_at, "prefix").groupBy("key").agg(F.collect_list("entry").alias("stack"))


def sweep(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, best) of the distinct (host, path) rows of ``urls`` that some rule fits; best is the winning entry."""
    spark = urls.sparkSession
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.", -1))).alias("n")).first()["n"] or 0
    stacks = saved(stacked_rules(rules), "url-rules")
    by_site = (
        urls.withColumn("labels", _labels(F.col("host")))
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(1, deepest))))))
        .withColumn("site", F.array_join(F.expr("slice(labels, 1, depth)"), "."))
        .select(_key(F.col("site"), F.col("path")).alias("key"), "host", "path", "site", F.lit(None).cast(f"array<{_ENTRY}>").alias("stack"))
    )
    starts = stacks.select("key", *(F.lit(None).cast("string").alias(c) for c in ("host", "path", "site")), F.col("stack").cast(f"array<{_ENTRY}>").alias("stack"))
    events = by_site.unionByName(starts).repartitionByRange(4 * shuffle_partitions(spark), "key", "host").withColumn("zone", F.spark_partition_id())
    events = saved(events, "url-zones")

    zones = events.groupBy("zone").agg(F.max(F.when(F.col("stack").isNotNull(), F.struct("key", "stack"))).alias("last"))
    carried = zones.select("zone", F.last("last", ignorenulls=True).over(Window.orderBy("zone").rowsBetween(Window.unboundedPreceding, -1))["stack"].alias("carried"))
    order = Window.partitionBy("zone").orderBy("key", F.col("stack").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("open", F.last("stack", ignorenulls=True).over(order)).filter("host is not null")
    swept = swept.join(carried, "zone", "left").withColumn("open", F.coalesce("open", "carried"))
    fits = lambda e: (e["site"] == F.col("site")) & F.col("path").startswith(e["path"])
    best = F.array_max(F.filter("open", fits))
    return swept.withColumn("best", best).filter("best is not null").groupBy("host", "path").agg(F.max("best").alias("best"))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``; columns of these names are replaced."""
    host, path = split_url(pages[url_col].cast("string"))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    judged = pages.select(*kept, host.alias("host"), path.alias("path"))
    best = sweep(judged.select("host", "path").distinct(), rules)
    return judged.join(best, ["host", "path"], "left").select(
        *(judged[c] for c in kept),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
