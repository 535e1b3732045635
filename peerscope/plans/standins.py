"""The driver's tables dressed as the source analyses' inputs.

Loans, lender transactions, deals and tax records are all built from
``lineitem``/``orders``/``customer``/``supplier``/``nation``/``region`` so every
query's work grows with those tables.  File-based inputs (fixed-width bank
records, yearly tax files, the spending sheet) are written by Spark from the
same tables into the shared checkpoint folder and read back.

Mapping (all ids are text, zero padded):

* county ``FIPS`` = nation key (5 digits); metro ``MSA`` = region key;
* zip = customer key mod 97; tract = home county + the last six digits of the
  customer key (customers that share them share a tract);
* year = year of the order date; home county 00011, merged pair 00007+00018;
* peers: nations with key mod 4 <> 1 plus ``MERGED``; current = key mod 2;
* population = 100000 + 1000 * nation + 250 * (year - 1995); price index
  = 100 + 2.5 * (year - 1995), base year 2000.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.operators.joins import join_dim
from peerscope.plans import cdfi, giving
from peerscope.session import scratch_path, session_key

HOME = "00011"
MERGED_PAIR = ("00007", "00018")
HOME_MSA = "00001"
HOME_CITY = "CITY_11"
BASE_YEAR = 2000
LAYOUT_SWITCH_YEAR = 1998
BRACKET_SPLIT_YEAR = 1998
FIRST_YEAR = 1995
CALENDAR = (1960, 2200)  # years of the stand-in population and price tables


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The driver's table (file listing and footers read once per session)."""
    key = (session_key(spark), d, name)
    if key not in _TABLES:
        df = spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")
        _TABLES[key] = df
    return _TABLES[key]


def code(c, width: int = 5) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(c.cast("string"), width, "0")


_DIMS: dict[tuple[str, str], Dimensions] = {}


def dimensions(spark: SparkSession, d: str) -> Dimensions:
    """Stand-in dimension tables (built once per session and folder)."""
    key = (session_key(spark), d)
    if key not in _DIMS:
        _DIMS[key] = _stored(spark, d, _build_dimensions(spark, d))
    return _DIMS[key]


def _stored(spark: SparkSession, d: str, dims: Dimensions) -> Dimensions:
    """The tables written once as Parquet: later plans scan them with known sizes instead of building them anew."""

    def table_of(name: str, df: DataFrame) -> DataFrame:
        path = _once(spark, d, f"dimension-{name}", lambda p: df.coalesce(1).write.parquet(p))  # bounded by places and years
        return spark.read.schema(df.schema).parquet(path)

    one = {f: table_of(f, getattr(dims, f)) for f in ("counties", "zips", "msa_counties", "msa_zips", "cpi")}
    many = {f: {k: table_of(f"{f}-{k}", t) for k, t in getattr(dims, f).items()} for f in ("peers", "population")}
    path = _once(spark, d, "dimension-crosswalk", lambda p: dims.crosswalk.write.parquet(p))
    return Dimensions(**one, **many, crosswalk=spark.read.schema(dims.crosswalk.schema).parquet(path))


def _build_dimensions(spark: SparkSession, d: str) -> Dimensions:
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    customer = table(spark, d, "customer")
    n = F.col("n_nationkey")
    counties = nation.select(
        code(n).alias("FIPS"), F.col("n_name").alias("county"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state_abbr")
    )
    z = F.col("id")
    zips = spark.range(97).select(
        code(z).alias("zip"),
        code(z % 25).alias("FIPS"),
        F.when(z == 36, F.lit(0.0)).otherwise(1000.0 + 37 * z).alias("population_total"),
        F.when(z == 36, F.lit(0.0)).otherwise(1000.0 + 37 * z).alias("population_in_FIPS"),
    )
    msa_counties = nation.select(code(n).alias("FIPS"), code("n_regionkey").alias("MSA"))
    msa_zips = spark.range(90).select(code(z).alias("zip"), code((z % 25) % 5).alias("MSA"))
    peers_fips = nation.filter(n % 4 != 1).select(
        code(n).alias("FIPS"), F.concat(F.lit("CITY_"), n.cast("string")).alias("city"), (n % 2).cast("int").alias("current")
    )
    peers_fips = peers_fips.unionByName(
        spark.range(1).select(F.lit("MERGED").alias("FIPS"), F.lit("CITY_MERGED").alias("city"), F.lit(1).alias("current"))
    )
    r = F.col("r_regionkey")
    peers_msa = region.filter(r != 3).select(
        code(r).alias("MSA"), F.concat(F.lit("METRO_"), r.cast("string")).alias("city"), F.lit(1).alias("current")
    )
    years = F.explode(F.sequence(F.lit(CALENDAR[0]), F.lit(CALENDAR[1])))
    pop = nation.select(code(n).alias("FIPS"), code("n_regionkey").alias("MSA"), n, years.alias("year")).withColumn(
        "population", (100000 + 1000 * n + 250 * (F.col("year") - FIRST_YEAR)).cast("double")
    )
    merged = (
        pop.filter(F.col("FIPS").isin(list(MERGED_PAIR)))
        .groupBy("year")
        .agg(F.sum("population").alias("population"))
        .withColumn("FIPS", F.lit("MERGED"))
    )
    pop_fips = pop.select("FIPS", "year", "population").unionByName(merged)
    pop_msa = pop.groupBy("MSA", "year").agg(F.sum("population").alias("population"))
    cpi = spark.range(CALENDAR[0], CALENDAR[1] + 1).select(
        F.col("id").cast("int").alias("year"), (100 + 2.5 * (F.col("id") - FIRST_YEAR)).cast("double").alias("cpi")
    )
    k = F.col("c_custkey") % 1000000
    home_tracts = customer.filter(F.col("c_nationkey") == int(HOME)).select(
        F.concat(F.lit(HOME), code(k, 6)).alias("tract"), (100 + k % 50).cast("double").alias("population"), k.alias("k")
    )
    crosswalk = (
        home_tracts.select("tract", F.lit("nh").alias("layer"), F.concat(F.lit("NH"), (F.col("k") % 7).cast("string")).alias("neighborhood"), "population")
        .unionByName(
            home_tracts.select("tract", F.lit("muw").alias("layer"), F.concat(F.lit("MUW"), (F.col("k") % 5).cast("string")).alias("neighborhood"), "population")
        )
        .distinct()
    )
    return Dimensions(
        counties=counties,
        zips=zips,
        msa_counties=msa_counties,
        msa_zips=msa_zips,
        peers={"FIPS": peers_fips, "MSA": peers_msa},
        population={"FIPS": pop_fips, "MSA": pop_msa},
        cpi=cpi,
        crosswalk=crosswalk,
    )


def split_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """Tracts that lie in up to three areas of a layer: shares in thousandths that sum to one."""
    k = F.col("c_custkey") % 1000000
    tracts = table(spark, d, "customer").filter(F.col("c_nationkey") == int(HOME)).select(F.concat(F.lit(HOME), code(k, 6)).alias("tract"), k.alias("k")).distinct()
    area = lambda name, n, shift: F.concat(F.lit(name), ((F.col("k") + shift) % n).cast("string"))
    share = lambda c: c.cast("decimal(9,6)") / F.lit(1000)
    a, b = F.col("k") % 600 + 100, F.col("k") % 250 + 1
    part = lambda layer, place, s: F.struct(F.lit(layer).alias("layer"), place.alias("neighborhood"), share(s).cast("decimal(9,6)").alias("share"))
    parts = F.array(
        part("nh", area("NH", 7, 0), a), part("nh", area("NH", 7, 1), b), part("nh", area("NH", 7, 3), 1000 - a - b), part("muw", area("MUW", 5, 0), b), part("muw", area("MUW", 5, 2), 1000 - b)
    )
    return tracts.select("tract", F.explode(parts).alias("p")).select("tract", "p.layer", "p.neighborhood", "p.share")


def _orders_customers(spark: SparkSession, d: str, with_nation: bool = True) -> DataFrame:
    """orders x customer (x nation): the smaller join done first so that
    ``lineitem`` is shuffled once when it is joined on."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name", "c_acctbal")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    if with_nation:
        n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
        oc = join_dim(oc.withColumnRenamed("c_nationkey", "n_nationkey"), n, "n_nationkey", how="inner")
        oc = oc.withColumn("c_nationkey", F.col("n_nationkey"))
    return oc


def _lines(spark: SparkSession, d: str, cols: list[str]) -> DataFrame:
    """lineitem x (orders x customer x nation).

    Both sides grow with the data, so this is a sort-merge join on the order
    key (never a broadcast of either side); without cost statistics Spark
    would otherwise estimate the joined side as a product of its inputs and
    broadcast ``lineitem`` itself at small scale.
    """
    li = table(spark, d, "lineitem").select("l_orderkey", *cols)
    oc = _orders_customers(spark, d)
    return li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey)


def sba_7a_raw(spark: SparkSession, d: str) -> DataFrame:
    j = _lines(spark, d, ["l_extendedprice", "l_discount"])
    return j.select(
        code(F.col("c_custkey") % 97).alias("BorrZip"),
        F.col("l_extendedprice").alias("GrossApproval"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("SBAGuaranteedApproval"),
        F.col("o_orderdate").alias("ApprovalDate"),
        F.upper("n_name").alias("ProjectCounty"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("ProjectState"),
    )


def sba_504_raw(spark: SparkSession, d: str) -> DataFrame:
    """A sparse program: large lines of one part type only (cells go missing)."""
    part = table(spark, d, "part").filter(F.col("p_type") == "PROMO").select(F.col("p_partkey").alias("l_partkey"))
    li = table(spark, d, "lineitem").filter(F.col("l_quantity") >= 49).select("l_orderkey", "l_partkey", "l_extendedprice")
    li = join_dim(li, part, "l_partkey", how="left_semi")
    oc = _orders_customers(spark, d)
    j = li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey)
    return j.select(
        code(F.col("c_custkey") % 97).alias("BorrZip"),
        F.col("l_extendedprice").alias("GrossApproval"),
        F.col("o_orderdate").alias("ApprovalDate"),
        F.upper("n_name").alias("ProjectCounty"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("ProjectState"),
    )


def cdfi_raw(spark: SparkSession, d: str) -> DataFrame:
    j = _lines(spark, d, ["l_suppkey", "l_partkey", "l_linenumber", "l_extendedprice"])
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    t00 = F.when(ck % 7 == 0, F.lit("NONE")).otherwise((((nk + 3) % 25) * 1000000 + ck % 1000000).cast("string"))
    t10 = (
        F.when(ck % 10 == 0, F.lit("NONE"))
        .when(ck % 10 == 9, F.concat(ck.cast("string"), F.lit("000000000000")))
        .otherwise((nk * 1000000 + ck % 1000000).cast("string"))
    )
    date = F.when(F.col("l_linenumber") == 7, F.upper(F.date_format("o_orderdate", "dd-MMM"))).otherwise(
        F.upper(F.date_format("o_orderdate", "dd-MMM-yy"))
    )
    codes = F.array(*[F.lit(x) for x in list(cdfi.PURPOSE_RECODE) + ["UNLISTED"]])
    return j.select(
        F.col("l_suppkey").cast("double").alias("orgid"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("double").alias("transactionid"),
        F.col("l_extendedprice").alias("originalamount"),
        t00.alias("projectfipscode_2000"),
        t10.alias("projectfipscode_2010"),
        F.col("c_name").alias("investee"),
        date.alias("dateclosed"),
        F.element_at(codes, (F.col("l_partkey") % 15 + 1).cast("int")).alias("purpose"),
    )


def deals_raw(spark: SparkSession, d: str) -> DataFrame:
    oc = _orders_customers(spark, d, with_nation=False)
    missing = (F.col("o_orderkey") % 10 == 0) | ((F.year("o_orderdate") == 2001) & (F.col("c_nationkey") % 5 == 4))
    return oc.select(
        F.col("c_name").alias("Company Name"),
        code(F.col("c_custkey") % 97).alias("Company Post Code"),
        F.col("o_orderdate").alias("Deal Date"),
        F.when(~missing, F.col("o_totalprice")).alias("Deal Size"),
    )


def companies_raw(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(
        F.col("s_name").alias("Company Name"),
        F.concat(F.lit("LOC_"), F.col("s_nationkey").cast("string")).alias("HQ Location"),
        code(F.col("s_suppkey") % 97).alias("HQ Post Code"),
    )


# ---------------------------------------------------------------- files


def _num(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, " ")


def cra_records(spark: SparkSession, d: str) -> DataFrame:
    """Fixed-width bank records: old layout before the switch year, new after."""
    j = _lines(spark, d, ["l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey"])
    ln, ck = F.col("l_linenumber"), F.col("c_custkey")
    year = F.year("o_orderdate")
    tbl = F.rpad(F.when(ln == 1, F.lit("D1-1")).when(ln == 6, F.lit("A1-2")).otherwise(F.lit("A1-1")), 5, " ")
    level = F.when(ln == 2, F.lit("200")).when(ln == 3, F.lit("210")).otherwise(F.lit("   "))
    k6 = code(ck % 1000000, 6)
    tract = F.when(ln.isin(2, 3), F.lit(" " * 7)).otherwise(F.concat(F.substring(k6, 1, 4), F.lit("."), F.substring(k6, 5, 2)))
    vals = [
        F.col("l_quantity").cast("bigint"),
        F.floor(F.col("l_extendedprice") / 10).cast("bigint"),
        ln.cast("bigint"),
        F.col("l_partkey") % 997,
        F.col("l_suppkey") % 100,
        F.when(F.col("l_orderkey") % 1009 != 0, F.col("l_orderkey") % 1000),
        F.col("l_partkey") % 50,
        F.floor(F.col("l_extendedprice")).cast("bigint") % 100000,
    ]

    def line(msa_w: int, num_w: int, amt_w: int) -> Column:
        fields = [_num(F.coalesce(v.cast("string"), F.lit("")), num_w if i % 2 == 0 else amt_w) for i, v in enumerate(vals)]
        return F.concat(
            tbl, year.cast("string"), F.lit("  "), code("c_nationkey"), code("n_regionkey", msa_w), tract, F.lit("  "),
            code(ck % 4, 3), level, *fields,
        )

    return j.select(F.when(year < LAYOUT_SWITCH_YEAR, line(4, 6, 8)).otherwise(line(5, 10, 10)).alias("value"))


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, d: str, kind: str, write) -> str:
    """Write a derived input once per session and folder; reuse the path."""
    key = (session_key(spark), d, kind)
    if key not in _WRITTEN:
        path = scratch_path(spark, kind)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


@contextmanager
def unsorted_folders(spark: SparkSession, most: int = 100) -> Iterator[None]:
    """Writes in here keep a file open for each folder that a task meets, up to ``most``: its rows are not sorted by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_cra_files(spark: SparkSession, d: str) -> str:
    """Fixed-width records, one folder per year (``year=YYYY``): in name order
    the first folders hold the old layout, the rest the new.  Read whole (a
    per-line layout selector) or folder by folder (layout by position)."""

    def write(path: str) -> None:
        recs = cra_records(spark, d).withColumn("year", F.substring("value", 6, 4))
        with unsorted_folders(spark):
            recs.write.mode("overwrite").partitionBy("year").text(path)

    return _once(spark, d, "cra", write)


SHEET_ROWS = 8_000_000  # rows of all kinds together in a round of files


def write_sheets(data: DataFrame, tops: list[str], path: str) -> None:
    """Text files with the lines ``tops`` above the values of ``data`` (k, row, value), apart by ``k`` and, beyond SHEET_ROWS
    rows, by the hash of ``row``: no file, and no task that writes one, grows with the tables."""
    rounds = data.count() // SHEET_ROWS + 1
    data = data.select("k", F.pmod(F.xxhash64("row"), F.lit(rounds)).alias("round"), F.lit(len(tops)).alias("place"), "value")
    top = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(t).alias("value")) for i, t in enumerate(tops)])).alias("t")
    head = data.select("k", "round").distinct().select("k", "round", top).select("k", "round", "t.place", "t.value")
    sheet = data.unionByName(head).repartition("k", "round").sortWithinPartitions("k", "round", "place")
    sheet.select("k", "round", "value").write.mode("overwrite").partitionBy("k", "round").text(path)


def giving_records(spark: SparkSession, d: str) -> DataFrame:
    """One tax-statistics row per order, with the source's column names."""
    oc = _orders_customers(spark, d, with_nation=False)
    year = F.year("o_orderdate")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    status = F.col("o_orderstatus")
    return oc.select(
        year.alias("year"),
        F.lit("00").alias("STATEFIPS"),
        code("c_nationkey", 3).alias("COUNTYFIPS"),
        F.when(year < BRACKET_SPLIT_YEAR, F.least(digit, F.lit(4))).otherwise(digit).alias("agi_stub"),
        F.lit(1).alias("N1"),
        F.col("o_totalprice").alias("A19700"),
        F.when(status == "F", 1).otherwise(0).alias("N19700"),
        F.col("c_acctbal").alias("A00100"),
        F.when(status != "O", 1).otherwise(0).alias("N04470"),
        F.lit(1).alias("N02650"),
        (F.col("o_totalprice") + 500).alias("A02650"),
        F.when(status == "O", 1).otherwise(0).alias("MARS1"),
        F.when(status == "O", 0).otherwise(1).alias("MARS2"),
        F.lit(0).alias("MARS4"),
        (F.col("c_custkey") % 3).alias("NUMDEP"),
    )


def giving_columns(year: int) -> list[str]:
    """Per-year header: odd years spell ``mars1`` in lower case, 1996 has no
    ``MARS4`` and 1995 no ``NUMDEP`` (schema drift)."""
    cols = [giving.GIVING_RENAMES.get(c, c) for c in giving.GIVING_COLUMNS if c != "MARS1"]  # its renamed variant stands first
    if year == 1996:
        cols.remove("MARS4")
    if year == 1995:
        cols.remove("NUMDEP")
    return cols


def write_giving_files(spark: SparkSession, d: str) -> str:
    """One folder per year (``giving_<year>``), each with its own header."""
    return _once(spark, d, "giving", lambda path: _write_giving(spark, d, path))


def _write_giving(spark: SparkSession, d: str, path: str) -> None:
    """One pass over the tables into a year-partitioned stage, then each
    year's CSV (own header) from its pruned partition."""
    stage = f"{path}/_stage"
    giving_records(spark, d).write.mode("overwrite").partitionBy("year").parquet(stage)
    staged = spark.read.parquet(stage)
    years = [r.year for r in staged.select("year").distinct().collect()]  # partition values: listing only

    def write_year(y: int) -> None:
        cols = giving_columns(y)
        sel = [F.col(c).alias("mars1" if (c == "MARS1" and y % 2 == 1) else c) for c in cols]
        staged.filter(F.col("year") == y).select(*sel).write.mode("overwrite").option("header", True).csv(f"{path}/giving_{y}")

    # independent jobs: submitted together so they share the cluster
    with ThreadPoolExecutor(max_workers=min(8, max(1, len(years)))) as pool:
        list(pool.map(write_year, sorted(years)))


def spending_records(spark: SparkSession, d: str) -> DataFrame:
    """A spending sheet: blank-header label column, unpadded code, amounts as
    formatted text (grouping commas, some ``$`` prefixes and notes)."""
    c = table(spark, d, "customer")
    ck, bal = F.col("c_custkey"), F.col("c_acctbal")
    text = F.format_number(bal, 2)
    text = F.when((ck % 3 == 0) & (bal >= 0), F.concat(F.lit("$"), text)).otherwise(text)
    text = F.when(ck % 5 == 0, F.concat(text, F.lit(" (est.)"))).otherwise(text)
    return c.select(
        F.col("c_name").alias(""),
        ck.cast("string").alias("FIPS"),
        text.alias("General Fund spending per capita"),
        F.col("c_nationkey").cast("string").alias("General Fund tax burden per capita"),
        F.lit("n/a").alias("Net gain for residents"),
    )


def write_spending_file(spark: SparkSession, d: str) -> str:
    return _once(spark, d, "spending", lambda path: spending_records(spark, d).write.mode("overwrite").option("header", True).csv(path))
