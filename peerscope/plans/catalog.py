"""Registered queries over the driver's tables (one per operator family).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns match the DuckDB statement of the same name in
``peerscope.plans.oracle``.  Money sums are exact decimals; values that are
means of doubles are rounded to 9 decimals at the output (the order of a
floating-point sum differs between engines in the last bit).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscope.functions.format import dollar_text, label, percent_text, signif
from peerscope.functions.nulls import if_else, strict_mean, strict_sum, sum0
from peerscope.functions.text import pad_left, remove_first, replace_first
from peerscope.operators.geo import allocate, stack_layers
from peerscope.operators.joins import JoinChecks, bind_panels, join_dim
from peerscope.operators.materialize import materialize
from peerscope.operators.panel import rank_table, trend
from peerscope.plans import cdfi, cra, giving, sba, spending, venture
from peerscope.plans import standins as S
from peerscope.plans.reports import map_layers, real_series
from peerscope.session import scratch_path
from peerscope.sources.delimited import read_delimited
from peerscope.sources.fixed_width import Layout, layout_by_year, read_fixed_width
from peerscope.sources.infer import read_inferred
from peerscope.sources.sinks import read_csv_na, read_table, write_csv_na, write_many, write_table

MIN_YEAR = 1996
TX_MIN_YEAR = 1997
SBA_7A = {"sba_loan": "SBAGuaranteedApproval", "total_loan": "GrossApproval"}
SBA_504 = {"total_504": "GrossApproval"}


def _r9(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


# ------------------------------------------------------------------ loans


def _loans_7a(spark, d, dims):
    return sba.clean_loans(S.sba_7a_raw(spark, d), dims, SBA_7A, min_year=MIN_YEAR)


def _loans_504(spark, d, dims):
    return sba.clean_loans(S.sba_504_raw(spark, d), dims, SBA_504, min_year=MIN_YEAR)


def _county_7a(spark, d, dims=None):
    dims = dims or S.dimensions(spark, d)
    return sba.county_panel(_loans_7a(spark, d, dims), dims, list(SBA_7A), S.BASE_YEAR, S.MERGED_PAIR)


def _county_504(spark, d, dims=None):
    dims = dims or S.dimensions(spark, d)
    return sba.county_panel(_loans_504(spark, d, dims), dims, list(SBA_504), S.BASE_YEAR, S.MERGED_PAIR, complete=True)


def _zip_7a(spark, d, dims=None):
    dims = dims or S.dimensions(spark, d)
    return sba.zip_panel(_loans_7a(spark, d, dims), dims, list(SBA_7A), S.HOME, S.BASE_YEAR)


def _zip_504(spark, d, dims=None):
    dims = dims or S.dimensions(spark, d)
    return sba.zip_panel(_loans_504(spark, d, dims), dims, list(SBA_504), S.HOME, S.BASE_YEAR)


def q01_county_panel(spark: SparkSession, d: str) -> DataFrame:
    return _county_7a(spark, d).select("FIPS", "year", "sba_loan", "total_loan", "sba_loan_pp", "total_loan_pp")


def q02_zip_panel(spark: SparkSession, d: str) -> DataFrame:
    return _zip_7a(spark, d).select("zip", "year", "sba_loan", "total_loan", "sba_loan_pp", "total_loan_pp")


def q03_sparse_panel_complete(spark: SparkSession, d: str) -> DataFrame:
    return _county_504(spark, d).select("FIPS", "year", "total_504", "total_504_pp")


def q04_zip_504_panel(spark: SparkSession, d: str) -> DataFrame:
    return _zip_504(spark, d).select("zip", "year", "total_504", "total_504_pp")


def q05_bind_panels(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    both = bind_panels(_county_7a(spark, d, dims), _county_504(spark, d, dims), ["FIPS", "year"])
    return both.select("FIPS", "year", "sba_loan", "total_loan", "total_504", "sba_loan_pp", "total_loan_pp", "total_504_pp")


def q05_bind_inferred_keys(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    both = bind_panels(_zip_7a(spark, d, dims), _zip_504(spark, d, dims))
    return both.select("zip", "year", "sba_loan", "total_loan", "total_504", "sba_loan_pp", "total_loan_pp", "total_504_pp")


def _sba_results(spark, d):
    """Both programs' panels under the published names, through ``sba.combine``."""
    dims = S.dimensions(spark, d)
    both = {"sba_loan_7a": "SBAGuaranteedApproval", "total_loan_7a": "GrossApproval"}
    one = {"total_loan_504": "GrossApproval"}
    a = sba.clean_loans(S.sba_7a_raw(spark, d), dims, both, min_year=MIN_YEAR)
    b = sba.clean_loans(S.sba_504_raw(spark, d), dims, one, min_year=MIN_YEAR)
    return sba.combine(
        sba.county_panel(a, dims, list(both), S.BASE_YEAR, S.MERGED_PAIR),
        sba.county_panel(b, dims, list(one), S.BASE_YEAR, S.MERGED_PAIR, complete=True),
        sba.zip_panel(a, dims, list(both), S.HOME, S.BASE_YEAR),
        sba.zip_panel(b, dims, list(one), S.HOME, S.BASE_YEAR),
    )


def q05_combined_results(spark: SparkSession, d: str) -> DataFrame:
    """The loan analysis end to end: both result sets written under their names and read back."""
    path = scratch_path(spark, "sba_results")
    results = _sba_results(spark, d)
    write_many(results, path, fmt="parquet")
    county = read_table(spark, f"{path}/sba_county").withColumnRenamed("FIPS", "place").withColumn("result", F.lit("sba_county"))
    zips = read_table(spark, f"{path}/sba_zip").withColumnRenamed("zip", "place").withColumn("result", F.lit("sba_zip"))
    return county.unionByName(zips)


# ------------------------------------------------------------ lenders


def _transactions(spark, d, dims):
    return cdfi.clean_transactions(S.cdfi_raw(spark, d), dims, min_year=TX_MIN_YEAR)


def q06_clean_codes(spark: SparkSession, d: str) -> DataFrame:
    tx = _transactions(spark, d, S.dimensions(spark, d))
    return tx.select("transactionid", "originalamount", "FIPS", "tract_10", "tract_00", "day", "month", "year", "purpose")


def q07_cdfi_county(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    return cdfi.county_panel(_transactions(spark, d, dims), dims, S.BASE_YEAR, S.MERGED_PAIR).select("FIPS", "year", "cdfi", "cdfi_pp")


def q08_msa_rollup(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    return cdfi.msa_panel(_transactions(spark, d, dims), dims, S.BASE_YEAR).select("MSA", "year", "cdfi", "cdfi_pp")


def _cdfi_layers(spark, d, dims):
    return cdfi.map_layers(_transactions(spark, d, dims), dims, S.HOME, TX_MIN_YEAR, S.BASE_YEAR)


def q09_crosswalk_sum(spark: SparkSession, d: str) -> DataFrame:
    layers = _cdfi_layers(spark, d, S.dimensions(spark, d))
    return stack_layers(layers).select("layer", "area", "year", "cdfi", "cdfi_pp")


def q09_split_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """Tract sums divided over the areas that share a tract; ``whole``: the layer's total equals the tracts'."""
    dims = S.dimensions(spark, d)
    tx = _transactions(spark, d, dims).filter(F.col("tract_10").startswith(S.HOME))
    tracts = tx.groupBy(F.col("tract_10").alias("tract"), "year").agg(strict_sum("originalamount", 4).alias("cdfi"))
    areas = materialize(allocate(tracts, S.split_crosswalk(spark, d), ["cdfi"]))
    exact4 = lambda c: F.sum(F.col(c).cast("decimal(22,4)"))
    totals = areas.groupBy("layer", "year").agg(exact4("cdfi").alias("area_total"))
    totals = totals.join(tracts.groupBy("year").agg(exact4("cdfi").alias("tract_total")), "year")
    whole = totals.select("layer", "year", (F.col("area_total") == F.col("tract_total")).alias("whole"))
    return areas.join(whole, ["layer", "year"]).select("layer", "neighborhood", "year", "cdfi", "whole")


def q08_checked_join(spark: SparkSession, d: str) -> DataFrame:
    """Lender dollars by metro, published only if the join to the metro map kept every row and met no null key."""
    dims, checks = S.dimensions(spark, d), JoinChecks()
    joined = checks.join(_transactions(spark, d, dims), dims.msa_counties, "FIPS", nulls=False)
    out = joined.groupBy("MSA").agg(F.count(F.lit(1)).alias("transactions"), strict_sum("originalamount", 4).alias("cdfi"))
    path = scratch_path(spark, "checked")
    write_table(out, path, checks=checks)
    rows = checks.verify()[0]
    return read_table(spark, path).withColumns({"fact_rows": F.lit(rows["rows"]).cast("bigint"), "joined_rows": F.lit(rows["joined"]).cast("bigint")})


def q09_cdfi_results(spark: SparkSession, d: str) -> DataFrame:
    """The five lender results written under their names and read back."""
    dims = S.dimensions(spark, d)
    tx = materialize(_transactions(spark, d, dims))  # read by all five
    results = {
        "cdfi_county": cdfi.county_panel(tx, dims, S.BASE_YEAR, S.MERGED_PAIR),
        "cdfi_msa": cdfi.msa_panel(tx, dims, S.BASE_YEAR),
        **cdfi.map_layers(tx, dims, S.HOME, TX_MIN_YEAR, S.BASE_YEAR),
    }
    return _published(spark, "cdfi_results", results, ["cdfi", "cdfi_pp"])


def _published(spark: SparkSession, name: str, results: dict[str, DataFrame], measures: list[str]) -> DataFrame:
    """Named results written, read back and stacked: (result, place, year, measures)."""
    path = scratch_path(spark, name)
    write_many(results, path, fmt="parquet")
    out = None
    for result in results:
        back = read_table(spark, f"{path}/{result}")
        place = next(c for c in ("FIPS", "MSA", "tract", "neighborhood") if c in back.columns)
        back = back.select(F.lit(result).alias("result"), F.col(place).alias("place"), "year", *[m for m in measures if m in back.columns])
        out = back if out is None else out.unionByName(back, allowMissingColumns=True)
    return out


# ------------------------------------------------------------- bank loans


def _cra(spark, d):
    path = S.write_cra_files(spark, d)
    lines = cra.read_by_selector(spark, path, layout_by_year(6, 4, S.LAYOUT_SWITCH_YEAR))
    return cra.normalize(lines)


CRA_MEASURES = [n for part in ("num", "amount") for n in cra.NEW_LAYOUT.names if part in n] + ["all_sb_loans"]


def q10_fixed_width(spark: SparkSession, d: str) -> DataFrame:
    return _cra(spark, d).select("FIPS", "tract", "year", "income_group", "geog_level", *CRA_MEASURES)


def q10_fixed_width_by_file_order(spark: SparkSession, d: str) -> DataFrame:
    """Layout chosen by file position: the first folders (years before the
    switch) are read with the old layout, the rest with the new."""
    path = S.write_cra_files(spark, d)
    n_old = S.LAYOUT_SWITCH_YEAR - S.FIRST_YEAR
    lines = cra.read_by_file_order(spark, path, n_old=n_old)
    return cra.normalize(lines).select("FIPS", "tract", "year", "income_group", "geog_level", *CRA_MEASURES)


def q11_cra_county(spark: SparkSession, d: str) -> DataFrame:
    p = cra.county_panel(_cra(spark, d), S.dimensions(spark, d), S.BASE_YEAR, S.MERGED_PAIR)
    return p.select("FIPS", "year", *CRA_MEASURES, *[f"{m}_pp" for m in CRA_MEASURES])


def q12_cra_msa(spark: SparkSession, d: str) -> DataFrame:
    p = cra.msa_panel(_cra(spark, d), S.dimensions(spark, d), S.BASE_YEAR)
    return p.select("MSA", "year", *CRA_MEASURES, *[f"{m}_pp" for m in CRA_MEASURES])


def q13_crosswalk_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    layers = cra.map_layers(_cra(spark, d), S.dimensions(spark, d), S.HOME, MIN_YEAR, S.BASE_YEAR)
    cols = ["amount_business_1m", "all_sb_loans"]
    return stack_layers(layers).select("layer", "area", "year", *cols, *[f"{c}_pp" for c in cols])


def q13_cra_results(spark: SparkSession, d: str) -> DataFrame:
    """The five bank-loan results from one pass over the records, written under their names and read back."""
    results = cra.results(_cra(spark, d), S.dimensions(spark, d), S.HOME, MIN_YEAR, S.BASE_YEAR, S.MERGED_PAIR)
    return _published(spark, "cra_results", results, CRA_MEASURES + [f"{m}_pp" for m in CRA_MEASURES])


def q10_byte_exact(spark: SparkSession, d: str) -> DataFrame:
    """Fixed-width records whose names take several bytes a letter, read by byte positions."""
    c = S.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = S.table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = join_dim(c.withColumnRenamed("c_nationkey", "n_nationkey"), n, "n_nationkey", how="inner")
    name = F.translate(F.upper(F.left("n_name", F.lit(5))), "AEIO", "ÄÉÏØ")
    amount = F.lpad(F.format_string("%.2f", "c_acctbal"), 12, " ")
    line = F.concat(name, F.repeat(F.lit(" "), 14 - F.octet_length(name)), F.lpad(F.col("c_custkey").cast("string"), 10, " "), amount)
    path = S._once(spark, d, "bytes", lambda p: rows.select(line.alias("value")).write.mode("overwrite").text(p))
    layout = Layout.of([("name", 1, 14, "c"), ("custkey", 15, 24, "l"), ("acctbal", 25, 36, "d")])
    return read_fixed_width(spark, path, layout)


# ---------------------------------------------------------------- venture


def q14_count_per_home_pop(spark: SparkSession, d: str) -> DataFrame:
    out = venture.headquarters_by_msa(S.companies_raw(spark, d), S.dimensions(spark, d), S.HOME_MSA)
    return out.select("MSA", F.col("fortune_1000").cast("bigint").alias("fortune_1000"), "population", "fortune_1000_pp", "fortune_1000_per_lou")


def q15_deal_stats(spark: SparkSession, d: str) -> DataFrame:
    out = venture.deals_by_msa(S.deals_raw(spark, d), S.dimensions(spark, d), S.BASE_YEAR)
    return out.withColumn("deals", F.col("deals").cast("bigint"))


def q15_venture_results(spark: SparkSession, d: str) -> DataFrame:
    """Deals by metro under their published name: stored, rewritten from itself and read back."""
    name = f"venture_msa_{uuid.uuid4().hex}"
    write_table(q15_deal_stats(spark, d), name=name)
    write_table(read_table(spark, name=name).filter("deals > 1"), name=name)
    return read_table(spark, name=name)


# ----------------------------------------------------------------- giving


def _giving_rows(spark, d):
    return giving.read_giving(spark, S.write_giving_files(spark, d), start_year=S.FIRST_YEAR, glob="*.csv")


def _giving_panel(spark, d, dims=None):
    dims = dims or S.dimensions(spark, d)
    return giving.giving_panel(_giving_rows(spark, d), dims, S.MERGED_PAIR, merge_from=S.BRACKET_SPLIT_YEAR)


def q16_bracket_panel(spark: SparkSession, d: str) -> DataFrame:
    return _giving_panel(spark, d)


def q16_giving_results(spark: SparkSession, d: str) -> DataFrame:
    """The giving panel written as text under its published name and read back with the types that its values give."""
    path = scratch_path(spark, "giving_results")
    write_many({"charitable_giving": _giving_panel(spark, d).withColumn("agi", F.col("agi").cast("bigint"))}, path)
    back = read_inferred(spark, f"{path}/charitable_giving", types={"FIPS": "string"})
    numbers = [c for c in back.columns if c not in ("FIPS", "year", "agi")]
    return back.withColumns({c: F.col(c).cast("double") for c in numbers})


def q16_schema_drift_union(spark: SparkSession, d: str) -> DataFrame:
    rows = _giving_rows(spark, d)
    return rows.select(*[c for c in giving.GIVING_COLUMNS if c not in giving.GIVING_RENAMES], "year")


def q17_rank_two_metrics_long(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    return giving.ranks_long(_giving_panel(spark, d, dims), dims, agi=4, home_city=S.HOME_CITY)


def q18_home_vs_peer_table(spark: SparkSession, d: str) -> DataFrame:
    t = giving.itemizing_table(_giving_panel(spark, d), year=2000, home=S.HOME)
    return t.withColumns({"home_pct": _r9("home_pct"), "peer_pct": _r9("peer_pct")})


def q19_peer_gap(spark: SparkSession, d: str) -> DataFrame:
    g = giving.giving_gap(_giving_panel(spark, d), year=2000, agi=4, home=S.HOME)
    return g.withColumns({"percent_gap": _r9("percent_gap"), "dollar_gap": F.round("dollar_gap", 4)})


# --------------------------------------------------------------- spending


def q20_spending_rank(spark: SparkSession, d: str) -> DataFrame:
    table = spending.read_spending(spark, S.write_spending_file(spark, d))
    return spending.spending_rank(table).select("FIPS", "local_spend", "rank")


# ---------------------------------------------------------------- reports


def q21_rank_latest(spark: SparkSession, d: str) -> DataFrame:
    return rank_table(_county_7a(spark, d), "FIPS", "total_loan_pp").select("FIPS", "year", "total_loan_pp", "rank")


def q21_rank_year(spark: SparkSession, d: str) -> DataFrame:
    return rank_table(_county_7a(spark, d), "FIPS", "sba_loan_pp", year=1998).select("FIPS", "year", "sba_loan_pp", "rank")


def q21_rank_multi_year(spark: SparkSession, d: str) -> DataFrame:
    r = rank_table(_county_7a(spark, d), "FIPS", "total_loan_pp", years=[1998, 1999, 2000])
    return r.select("FIPS", _r9("total_loan_pp").alias("total_loan_pp"), "rank")


def q21_trend(spark: SparkSession, d: str) -> DataFrame:
    t = trend(_county_7a(spark, d), "FIPS", "total_loan_pp", S.HOME)
    return t.select("year", "home", _r9("peers").alias("peers"))


def q21_trend_roll3(spark: SparkSession, d: str) -> DataFrame:
    t = trend(_county_504(spark, d), "FIPS", "total_504_pp", S.HOME, rollmean=3)
    return t.select("year", _r9("home").alias("home"), _r9("peers").alias("peers"))


def q22_rebase_series(spark: SparkSession, d: str) -> DataFrame:
    o = S.table(spark, d, "orders")
    series = o.groupBy(F.year("o_orderdate").alias("year")).agg(strict_sum("o_totalprice", 4).alias("amount"))
    return real_series(series, S.dimensions(spark, d).cpi, S.BASE_YEAR).select("year", "amount", "real_amount")


def q23_map_layers_binned(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    layers = _cdfi_layers(spark, d, dims)
    xw = dims.crosswalk
    named = {
        "tract": layers["cdfi_tract"].withColumnRenamed("tract", "area"),
        "nh": layers["cdfi_nh"].withColumnRenamed("neighborhood", "area"),
        "muw": layers["cdfi_muw"].withColumnRenamed("neighborhood", "area"),
    }
    areas = {
        "tract": xw.select(F.col("tract").alias("area")).distinct(),
        "nh": xw.filter(F.col("layer") == "nh").select(F.col("neighborhood").alias("area")).distinct(),
        "muw": xw.filter(F.col("layer") == "muw").select(F.col("neighborhood").alias("area")).distinct(),
    }
    return map_layers(named, areas, "cdfi_pp", 2000).select("layer", "area", "cdfi_pp", "bin")


# ---------------------------------------------------------- column rules


def q24_first_match_replace(spark: SparkSession, d: str) -> DataFrame:
    p = S.table(spark, d, "part")
    text = F.upper(F.concat_ws(" ", "p_type", "p_name", F.lit("ST."), "p_brand"))
    dotted = F.concat_ws(".", "p_type", F.col("p_size").cast("string"), "p_brand")
    return p.select(
        "p_partkey",
        replace_first(text, "ST.", "SAINT").alias("wildcard"),
        replace_first(text, "ST.", "SAINT", literal=True).alias("literal"),
        remove_first(dotted, ".", literal=True).alias("undotted"),
        pad_left(F.col("p_partkey").cast("string"), 3).alias("padded"),
        replace_first(text, r"(.)\1", "Q").alias("doubled"),
        replace_first(F.concat(F.lit("ST\n"), F.col("p_brand"), F.lit(" ST9 ST8")), "ST.", "SAINT").alias("one_line"),
    )


def q25_strict_vs_skipping_sum(spark: SparkSession, d: str) -> DataFrame:
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = S.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey)
    x = F.when((F.col("l_linenumber") != 7) & (F.col("l_quantity") <= 45), F.col("l_extendedprice"))
    j = j.select(F.year("o_orderdate").alias("year"), "l_linenumber", x.alias("x"))
    return j.groupBy("year", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("x").alias("n_values"),
        strict_sum("x", 4).alias("strict_total"),
        sum0("x", 4).alias("total0"),
        strict_mean("x", 4).alias("strict_avg"),
        F.count(if_else(F.col("x") > 50000, 1, 0)).alias("n_flagged"),
    )


def q26_csv_na_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv_na")
    write_csv_na(q02_zip_panel(spark, d), path, order_by=["zip", "year"])
    schema = T.StructType(
        [T.StructField("zip", T.StringType()), T.StructField("year", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in ["sba_loan", "total_loan", "sba_loan_pp", "total_loan_pp"]]
    )
    return read_csv_na(spark, path, schema)


def q26_table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    name = f"peerscope_county_{uuid.uuid4().hex}"
    write_table(q01_county_panel(spark, d), name=name, partition_by=["year"])
    return read_table(spark, name=name).select("FIPS", "year", "sba_loan", "total_loan", "sba_loan_pp", "total_loan_pp")


def q26_self_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A stored panel rewritten from itself, by path and by name."""
    path, name = scratch_path(spark, "rewritten"), f"peerscope_rewritten_{uuid.uuid4().hex}"
    write_table(q01_county_panel(spark, d).select("FIPS", "year", "total_loan"), path)
    write_table(read_table(spark, path), name=name)
    for where in ({"path": path}, {"name": name}):
        for _ in range(2):
            kept = read_table(spark, **where).filter("year >= 1998").withColumn("total_loan", F.col("total_loan") * 2)
            write_table(kept, **where)
    by_path = read_table(spark, path).withColumn("by", F.lit("path"))
    return by_path.unionByName(read_table(spark, name=name).withColumn("by", F.lit("name")))


def q26_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Files read without declared types: codes keep their zeros, mixtures are text; ``kinds`` lists the types found."""
    k = F.col("o_orderkey")
    data = S.table(spark, d, "orders").select(
        k.cast("string").alias("key"),
        S.code(F.col("o_custkey") % 97).alias("code"),
        F.when(k % 5 == 0, "NA").when(F.col("o_orderstatus") == "F", "TRUE").otherwise("FALSE").alias("done"),
        F.when(k % 11 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(k % 3 == 0, F.col("o_totalprice").cast("bigint").cast("string")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(k % 3 == 0, "12").otherwise(F.col("o_orderpriority")).alias("mixed"),
        F.lit("NA").alias("nothing"),
    )
    path = S._once(spark, d, "untyped", lambda p: data.write.mode("overwrite").option("header", True).csv(p))
    back = read_inferred(spark, path)
    return back.withColumn("kinds", F.lit(" ".join(kind for _, kind in back.dtypes))).withColumn("nothing", F.col("nothing").cast("int"))


def q27_quoted_records(spark: SparkSession, d: str) -> DataFrame:
    """Files whose quoted fields hold line breaks, separators and quotes, with inch marks in plain fields; with and
    without title lines (one of them with an open quote) above the header."""
    o, k = S.table(spark, d, "orders"), F.col("o_orderkey")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = F.when(k % 5 == 0, quoted(F.concat(F.lit("one,\n"), F.col("o_orderstatus"), F.lit('\n\n"two" '), F.col("o_orderpriority"))))
    note = note.when(k % 5 == 1, F.concat(F.lit('5" pipe '), k.cast("string"))).otherwise(F.col("o_orderpriority"))
    last = F.when(k % 7 == 0, quoted(F.concat(F.lit("end\n"), k.cast("string")))).otherwise(F.lit('6"'))
    data = o.select((k % 3).alias("k"), k.alias("row"), F.concat_ws(",", k.cast("string"), note, F.col("o_custkey").cast("string"), last).alias("value"))
    titles, header = ['Orders, "all of them', "Amounts: none"], "order,note,customer,last"
    out = None
    for skip in (0, 2):
        path = S._once(spark, d, f"quoted-{skip}", lambda p: S.write_sheets(data, titles[:skip] + [header], p))
        back = read_delimited(spark, path, "ncnc", skip=skip).withColumn("skip", F.lit(skip))
        out = back if out is None else out.unionByName(back)
    return out


def _sheet_columns() -> list:
    return [
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.col("l_quantity").cast("string").alias("l_quantity"),
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("price"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        F.col("l_tax").cast("string").alias("l_tax"),
        F.col("l_discount").cast("string").alias("l_discount"),
        F.col("l_suppkey").cast("string").alias("l_suppkey"),
    ]


def q27_delimited_pruned_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files with a header line and formatted money, read with a compact type
    string; skipped columns are never parsed."""
    data = S.table(spark, d, "lineitem").select(*_sheet_columns())
    path = S._once(spark, d, "sheet", lambda p: data.write.mode("overwrite").option("header", True).csv(p))
    return read_delimited(spark, path, "nidnc_D___")


def q27_export_keeps_rows(spark: SparkSession, d: str) -> DataFrame:
    """Exports with two title lines above the header (a file or more for each
    line number), US dates, missing dates, ``NA`` codes and numbers with
    exponents: every data line is a row."""
    li = S.table(spark, d, "lineitem").withColumn("k", F.col("l_linenumber"))
    row = F.struct(
        F.col("l_orderkey").cast("string").alias("a"),
        F.col("l_linenumber").cast("string").alias("b"),
        F.when(F.col("l_linenumber") == 3, F.lit("")).otherwise(F.date_format("l_shipdate", "MM/dd/yyyy")).alias("c"),
        F.when(F.col("l_suppkey") % 5 == 0, F.lit("NA")).otherwise(F.col("l_suppkey").cast("string")).alias("d"),
        F.when(F.col("l_linenumber") == 2, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("E6"))).otherwise(F.concat(F.lit("."), F.col("l_quantity").cast("int").cast("string"))).alias("e"),
    )
    data = li.select("k", F.col("l_orderkey").alias("row"), F.to_csv(row).alias("value"))
    tops = ["Line items", "All amounts in dollars", "order,line,shipped,supplier,amount"]
    path = S._once(spark, d, "exports", lambda p: S.write_sheets(data, tops, p))
    back = read_delimited(spark, path, "niDcn", skip=2, date_format="MM/dd/yyyy")
    return back.select("order", "line", "shipped", "supplier", "amount")


def q28_label_text(spark: SparkSession, d: str) -> DataFrame:
    dims = S.dimensions(spark, d)
    ranked = rank_table(_county_7a(spark, d, dims), "FIPS", "total_loan_pp")
    ranked = join_dim(ranked, dims.peers_for("FIPS").select("FIPS", "city"), "FIPS", how="left")
    sig = signif("total_loan_pp", 4)
    return ranked.select(
        "FIPS",
        "city",
        "rank",
        sig.alias("value_sig4"),
        dollar_text(sig, 1).alias("value_text"),
        percent_text(F.col("total_loan_pp") / 10).alias("pct_text"),
        label("city", "rank").alias("label"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name[:1] == "q" and name[1:3].isdigit() and callable(fn)
}
