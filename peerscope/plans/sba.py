"""Small-business administration loans by county and by zip code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.functions.nulls import ratio, strict_sum
from peerscope.functions.text import replace_first
from peerscope.operators.geo import pull_peers, relabel_entity
from peerscope.operators.joins import bind_panels, join_dim, semi_filter
from peerscope.operators.metrics import deflate, per_capita
from peerscope.operators.panel import complete_panel
from peerscope.sources.delimited import header_names, read_delimited

# fixed values: home county and the county pair reported as one entity
HOME = "21111"
MERGED_PAIR = ("29189", "29510")


# fixed values: loan export columns kept (borrower block, two amounts, the
# approval date, county and state), one letter per column of the 36
LOAN_TYPES_7A = "__" + "ccccc" + "_" * 5 + "dd" + "D" + "_" * 10 + "cc" + "_" * 9


def read_loans(spark: SparkSession, path: str, col_types: str = LOAN_TYPES_7A, date_format: str | None = None) -> DataFrame:
    """Loan records exported from the program workbooks as delimited text.

    Only the typed columns are parsed; names come from the header.
    """
    return read_delimited(spark, path, col_types, date_format=date_format)


# fixed values: the columns of the 504 export that the analysis uses, and their types
COLUMNS_504 = {"BorrZip": "c", "GrossApproval": "n", "ApprovalDate": "D", "ProjectCounty": "c", "ProjectState": "c"}


def read_loans_504(spark: SparkSession, path: str, date_format: str | None = None) -> DataFrame:
    """The 504 export, its columns chosen by header name wherever they stand."""
    types = "".join(COLUMNS_504.get(c, "_") for c in header_names(spark, path))
    return read_delimited(spark, path, types, date_format=date_format).select(*COLUMNS_504)


def county_join_table(counties: DataFrame, literal_dot: bool = False) -> DataFrame:
    """County names as written in loan files: upper case, ``ST.`` spelled ``SAINT``.

    The default treats the ``.`` as any character, like the source analysis;
    ``literal_dot=True`` only rewrites a real ``ST.``.
    """
    return counties.select(
        "FIPS",
        F.col("state_abbr").alias("state"),
        replace_first(F.upper("county"), "ST.", "SAINT", literal=literal_dot).alias("county"),
    )


def clean_loans(
    raw: DataFrame,
    dims: Dimensions,
    measures: Mapping[str, str],
    min_year: int = 2000,
    literal_dot: bool = False,
) -> DataFrame:
    """Loan rows keyed by peer county: ``FIPS, zip, year, <measures>``.

    ``measures`` maps output names to source columns, e.g.
    ``{"sba_loan_7a": "SBAGuaranteedApproval", "total_loan_7a": "GrossApproval"}``.
    """
    df = raw.select(
        F.col("BorrZip").alias("zip"),
        F.substring(F.col("ApprovalDate").cast("string"), 1, 4).try_cast("int").alias("year"),
        *[F.col(src).cast("double").alias(dst) for dst, src in measures.items()],
        F.col("ProjectCounty").alias("county"),
        F.col("ProjectState").alias("state"),
        F.col("ApprovalDate").alias("__date"),
    )
    if dict(raw.dtypes).get("ApprovalDate") in ("date", "timestamp", "timestamp_ntz"):
        # same rows as the year test below, but Parquet can skip on it
        df = df.filter(F.col("__date") >= F.lit(f"{min_year}-01-01").cast(dict(raw.dtypes)["ApprovalDate"]))
    df = df.drop("__date")
    df = join_dim(df, county_join_table(dims.counties, literal_dot), ["state", "county"], how="left")
    df = pull_peers(df, dims, "FIPS")
    return df.select("FIPS", "zip", "year", *measures.keys()).filter(F.col("year") >= min_year)


def county_panel(
    loans: DataFrame,
    dims: Dimensions,
    measures: Sequence[str],
    base_year: int = 2019,
    members: Sequence[str] = MERGED_PAIR,
    complete: bool = False,
    exact_scale: int | None = 4,
) -> DataFrame:
    """Sum by county-year, merge the pair, optionally complete, deflate, per capita."""
    measures = list(measures)
    # merging the pair before the sum is the same as summing then merging,
    # and needs one shuffle
    loans = relabel_entity(loans, "FIPS", members)
    panel = loans.groupBy("FIPS", "year").agg(*[strict_sum(m, exact_scale).alias(m) for m in measures])
    if complete:
        panel = complete_panel(panel, "FIPS", "year", {m: 0.0 for m in measures})
    panel = deflate(panel, measures, dims.cpi, base_year)
    return per_capita(panel, measures, dims.pop_for("FIPS"), "FIPS")


def zip_panel(
    loans: DataFrame,
    dims: Dimensions,
    measures: Sequence[str],
    home: str = HOME,
    base_year: int = 2019,
    exact_scale: int | None = 4,
) -> DataFrame:
    """Zip-year sums for the home county's zip codes, deflated, per resident.

    Per-resident values are null where the zip population is zero.
    """
    measures = list(measures)
    home_zips = dims.zips.filter(F.col("FIPS") == home).select("zip")
    df = semi_filter(loans.filter(F.col("FIPS") == home), home_zips, "zip")
    panel = df.groupBy("FIPS", "zip", "year").agg(*[strict_sum(m, exact_scale).alias(m) for m in measures])
    panel = deflate(panel, measures, dims.cpi, base_year).drop("FIPS")
    # population_total is a zip attribute: one value per zip even if it spans counties
    zip_pop = dims.zips.select("zip", "population_total").distinct()
    panel = join_dim(panel, zip_pop, "zip", how="left")
    return panel.withColumns({f"{m}_pp": ratio(m, "population_total") for m in measures}).drop("population_total")


def combine(county_7a: DataFrame, county_504: DataFrame, zip_7a: DataFrame, zip_504: DataFrame) -> dict[str, DataFrame]:
    """Both programs side by side, by county and by zip."""
    county = bind_panels(county_7a, county_504, ["FIPS", "year"])
    zips = bind_panels(zip_7a, zip_504)
    order = ["sba_loan_7a", "total_loan_7a", "total_loan_504", "sba_loan_7a_pp", "total_loan_7a_pp", "total_loan_504_pp"]
    return {
        "sba_county": county.select("FIPS", "year", *order),
        "sba_zip": zips.select("zip", "year", *order),
    }
