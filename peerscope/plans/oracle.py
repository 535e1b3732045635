"""DuckDB statements equivalent to ``peerscope.plans.catalog``.

They compute each registered query straight from the driver's tables (the
views ``lineitem``, ``orders``, ... ) with the same stand-in mapping and the
same arithmetic order, so results can be compared value for value.
"""

from __future__ import annotations

from peerscope.plans.cdfi import PURPOSE_RECODE
from peerscope.plans.giving import BRACKETS, HOME_COLOR, METRIC_LABELS, OTHER_COLOR
from peerscope.plans.reports import MAP_BINS


def ssum(x: str) -> str:
    """Strict exact sum (null if any null), as ``strict_sum(x, 4)``."""
    return f"CASE WHEN count({x}) = count(*) THEN CAST(sum(CAST({x} AS DECIMAL(22,4))) AS DOUBLE) END"


def smean(cond: str, x: str) -> str:
    """Strict mean of x over rows where cond holds, as ``cond_mean``."""
    return (
        f"CASE WHEN count(CASE WHEN {cond} THEN 1 END) = count(CASE WHEN {cond} THEN {x} END) "
        f"THEN avg(CASE WHEN {cond} THEN {x} END) END"
    )


def pct_text(x: str) -> str:
    r = f"CAST(round(({x}) * 10) AS BIGINT)"
    return (
        f"CASE WHEN ({x}) IS NULL THEN NULL ELSE (CASE WHEN {r} < 0 THEN '-' ELSE '' END) || "
        f"format('{{:,}}', abs({r}) // 10) || '.' || CAST(abs({r}) % 10 AS VARCHAR) || '%' END"
    )


def dollar_text(x: str, digits: int = 0) -> str:
    m = 10**digits
    r = f"CAST(round(abs({x}) * {m}) AS BIGINT)"
    body = f"format('{{:,}}', {r})" if digits == 0 else f"format('{{:,}}', {r} // {m}) || '.' || lpad(CAST({r} % {m} AS VARCHAR), {digits}, '0')"
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE (CASE WHEN round(({x}) * {m}) < 0 THEN '-' ELSE '' END) || '$' || {body} END"


def rank_desc(x: str, part: str = "") -> str:
    p = f"{part}, " if part else ""
    return f"CAST(CASE WHEN {x} IS NULL THEN NULL ELSE rank() OVER (PARTITION BY {p}({x} IS NULL) ORDER BY {x} DESC) END AS INTEGER)"


def code(x: str, w: int = 5) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {w}, '0')"


HOME, MERGED = "'00011'", "('00007', '00018')"

DIMS = f"""
cpi AS (SELECT CAST(range AS INTEGER) AS year, CAST(100 + 2.5 * (range - 1995) AS DOUBLE) AS cpi FROM range(1960, 2201)),
fac AS (SELECT year, (SELECT cpi FROM cpi WHERE year = 2000) / cpi AS factor FROM cpi),
pop_n AS (SELECT {code('n_nationkey')} AS FIPS, {code('n_regionkey')} AS MSA, CAST(y.range AS INTEGER) AS year,
          CAST(100000 + 1000 * n_nationkey + 250 * (y.range - 1995) AS DOUBLE) AS population FROM nation, range(1960, 2201) y),
pop_fips AS (SELECT FIPS, year, population FROM pop_n
             UNION ALL SELECT 'MERGED', year, sum(population) FROM pop_n WHERE FIPS IN {MERGED} GROUP BY year),
pop_msa AS (SELECT MSA, year, sum(population) AS population FROM pop_n GROUP BY MSA, year),
pop_msa_latest AS (SELECT MSA, population FROM pop_msa WHERE year = 2200),
peers AS (SELECT {code('n_nationkey')} AS FIPS, 'CITY_' || CAST(n_nationkey AS VARCHAR) AS city, CAST(n_nationkey % 2 AS INTEGER) AS current
          FROM nation WHERE n_nationkey % 4 <> 1 UNION ALL SELECT 'MERGED', 'CITY_MERGED', 1),
peer_msa AS (SELECT {code('r_regionkey')} AS MSA FROM region WHERE r_regionkey <> 3),
msa_counties AS (SELECT {code('n_nationkey')} AS FIPS, {code('n_regionkey')} AS MSA FROM nation),
zips AS (SELECT {code('range')} AS zip, {code('range % 25')} AS FIPS,
         CASE WHEN range = 36 THEN 0.0 ELSE CAST(1000 + 37 * range AS DOUBLE) END AS population_total FROM range(97)),
msa_zips AS (SELECT {code('range')} AS zip, {code('(range % 25) % 5')} AS MSA FROM range(90)),
xw AS (SELECT DISTINCT '00011' || {code('c_custkey % 1000000', 6)} AS tract, lay.layer,
         CASE WHEN lay.layer = 'nh' THEN 'NH' || CAST((c_custkey % 1000000) % 7 AS VARCHAR)
              ELSE 'MUW' || CAST((c_custkey % 1000000) % 5 AS VARCHAR) END AS neighborhood,
         CAST(100 + (c_custkey % 1000000) % 50 AS DOUBLE) AS population
       FROM customer, (VALUES ('nh'), ('muw')) lay(layer) WHERE c_nationkey = 11),
tpop AS (SELECT tract, max(population) AS pop FROM xw GROUP BY tract),
apop AS (SELECT layer, neighborhood, sum(population) AS pop FROM xw GROUP BY layer, neighborhood),
oc AS (SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority, c_custkey, c_nationkey, c_name, c_acctbal
       FROM orders JOIN customer ON o_custkey = c_custkey)"""

LOANS = f"""
loans AS (SELECT {code('c_custkey % 97')} AS zip, CAST(year(o_orderdate) AS INTEGER) AS year,
          l_extendedprice * (1 - l_discount) AS sba_loan, l_extendedprice AS total_loan, {code('c_nationkey')} AS FIPS
          FROM lineitem JOIN oc ON l_orderkey = o_orderkey),
loans_p AS (SELECT * FROM loans WHERE FIPS IN (SELECT FIPS FROM peers) AND year >= 1996),
l504 AS (SELECT {code('c_custkey % 97')} AS zip, CAST(year(o_orderdate) AS INTEGER) AS year, l_extendedprice AS total_504,
         {code('c_nationkey')} AS FIPS FROM lineitem JOIN oc ON l_orderkey = o_orderkey
         WHERE l_quantity >= 49 AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')),
l504_p AS (SELECT * FROM l504 WHERE FIPS IN (SELECT FIPS FROM peers) AND year >= 1996)"""


def relabel(col: str = "FIPS") -> str:
    return f"CASE WHEN {col} IN {MERGED} THEN 'MERGED' ELSE {col} END"


COUNTY_7A = f"""
c7g AS (SELECT FIPS, year, {ssum('sba_loan')} AS sba_loan, {ssum('total_loan')} AS total_loan
        FROM (SELECT {relabel()} AS FIPS, year, sba_loan, total_loan FROM loans_p) GROUP BY FIPS, year),
c7d AS (SELECT g.FIPS, g.year, g.sba_loan * f.factor AS sba_loan, g.total_loan * f.factor AS total_loan FROM c7g g LEFT JOIN fac f ON g.year = f.year),
c7 AS (SELECT d.FIPS, d.year, d.sba_loan, d.total_loan, d.sba_loan / NULLIF(p.population, 0) AS sba_loan_pp,
       d.total_loan / NULLIF(p.population, 0) AS total_loan_pp FROM c7d d LEFT JOIN pop_fips p ON d.FIPS = p.FIPS AND d.year = p.year)"""

COUNTY_504 = f"""
c5g AS (SELECT FIPS, year, {ssum('total_504')} AS total_504
        FROM (SELECT {relabel()} AS FIPS, year, total_504 FROM l504_p) GROUP BY FIPS, year),
c5c AS (SELECT e.FIPS, y.year, coalesce(g.total_504, 0.0) AS total_504
        FROM (SELECT DISTINCT FIPS FROM c5g) e CROSS JOIN (SELECT DISTINCT year FROM c5g) y
        LEFT JOIN c5g g ON g.FIPS = e.FIPS AND g.year = y.year),
c5 AS (SELECT c.FIPS, c.year, c.total_504 * f.factor AS total_504, (c.total_504 * f.factor) / NULLIF(p.population, 0) AS total_504_pp
       FROM c5c c LEFT JOIN fac f ON c.year = f.year LEFT JOIN pop_fips p ON c.FIPS = p.FIPS AND c.year = p.year)"""

ZIP_7A = f"""
z7g AS (SELECT zip, year, {ssum('sba_loan')} AS sba_loan, {ssum('total_loan')} AS total_loan FROM loans_p
        WHERE FIPS = {HOME} AND zip IN (SELECT zip FROM zips WHERE FIPS = {HOME}) GROUP BY zip, year),
z7 AS (SELECT g.zip, g.year, g.sba_loan * f.factor AS sba_loan, g.total_loan * f.factor AS total_loan,
       (g.sba_loan * f.factor) / NULLIF(z.population_total, 0) AS sba_loan_pp, (g.total_loan * f.factor) / NULLIF(z.population_total, 0) AS total_loan_pp
       FROM z7g g LEFT JOIN fac f ON g.year = f.year LEFT JOIN (SELECT DISTINCT zip, population_total FROM zips) z ON g.zip = z.zip)"""

ZIP_504 = f"""
z5g AS (SELECT zip, year, {ssum('total_504')} AS total_504 FROM l504_p
        WHERE FIPS = {HOME} AND zip IN (SELECT zip FROM zips WHERE FIPS = {HOME}) GROUP BY zip, year),
z5 AS (SELECT g.zip, g.year, g.total_504 * f.factor AS total_504, (g.total_504 * f.factor) / NULLIF(z.population_total, 0) AS total_504_pp
       FROM z5g g LEFT JOIN fac f ON g.year = f.year LEFT JOIN (SELECT DISTINCT zip, population_total FROM zips) z ON g.zip = z.zip)"""

_codes = ", ".join(f"'{c}'" for c in list(PURPOSE_RECODE) + ["UNLISTED"])
_recode = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PURPOSE_RECODE.items())
TX = f"""
tx0 AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS DOUBLE) AS transactionid, l_extendedprice AS originalamount,
        CASE WHEN c_custkey % 7 = 0 THEN 'NONE' ELSE CAST(((c_nationkey + 3) % 25) * 1000000 + c_custkey % 1000000 AS VARCHAR) END AS p00,
        CASE WHEN c_custkey % 10 = 0 THEN 'NONE' WHEN c_custkey % 10 = 9 THEN CAST(c_custkey AS VARCHAR) || '000000000000'
             ELSE CAST(c_nationkey * 1000000 + c_custkey % 1000000 AS VARCHAR) END AS p10,
        CASE WHEN l_linenumber = 7 THEN upper(strftime(o_orderdate, '%d-%b')) ELSE upper(strftime(o_orderdate, '%d-%b-%y')) END AS dateclosed,
        ([{_codes}])[l_partkey % 15 + 1] AS purpose0
        FROM lineitem JOIN oc ON l_orderkey = o_orderkey),
tx1 AS (SELECT *, TRY_CAST(split_part(dateclosed, '-', 1) AS INTEGER) AS day, split_part(dateclosed, '-', 2) AS month,
        TRY_CAST(split_part(dateclosed, '-', 3) AS INTEGER) AS yy FROM tx0),
tx2 AS (SELECT *, CASE WHEN yy >= 84 THEN yy + 1900 WHEN yy < 84 THEN yy + 2000 END AS year FROM tx1),
tx3 AS (SELECT *, lpad(NULLIF(p00, 'NONE'), CAST(greatest(length(NULLIF(p00, 'NONE')), 11) AS INTEGER), '0') AS t00,
        lpad(NULLIF(p10, 'NONE'), CAST(greatest(length(NULLIF(p10, 'NONE')), 11) AS INTEGER), '0') AS t10 FROM tx2 WHERE year >= 1997),
tx AS (SELECT transactionid, originalamount, coalesce(substr(t10, 1, 5), substr(t00, 1, 5)) AS FIPS, t10 AS tract_10, t00 AS tract_00,
       day, month, year, CASE purpose0 {_recode} ELSE purpose0 END AS purpose FROM tx3
       WHERE coalesce(substr(t10, 1, 5), substr(t00, 1, 5)) IN (SELECT FIPS FROM msa_counties WHERE MSA IN (SELECT MSA FROM peer_msa)))"""

CDFI_LAYERS = f"""
tr AS (SELECT tract_10 AS tract, year, {ssum('originalamount')} AS cdfi FROM tx WHERE year >= 1997 AND starts_with(tract_10, {HOME}) GROUP BY tract_10, year),
ar AS (SELECT x.layer, x.neighborhood, tr.year, {ssum('tr.cdfi')} AS cdfi FROM tr JOIN xw x ON tr.tract = x.tract GROUP BY x.layer, x.neighborhood, tr.year),
cl AS (SELECT 'tract' AS layer, tr.tract AS area, tr.year, tr.cdfi * f.factor AS cdfi, (tr.cdfi / NULLIF(t.pop, 0)) * f.factor AS cdfi_pp
       FROM tr LEFT JOIN tpop t ON tr.tract = t.tract LEFT JOIN fac f ON tr.year = f.year
       UNION ALL
       SELECT ar.layer, ar.neighborhood, ar.year, ar.cdfi * f.factor, (ar.cdfi / NULLIF(a.pop, 0)) * f.factor
       FROM ar LEFT JOIN apop a ON ar.layer = a.layer AND ar.neighborhood = a.neighborhood LEFT JOIN fac f ON ar.year = f.year)"""

CRA_NUMS = ["num_under_100k", "num_100k_250k", "num_250k_1m", "num_business_1m"]
CRA_AMTS = ["amount_under_100k", "amount_100k_250k", "amount_250k_1m", "amount_business_1m", "all_sb_loans"]
CRA_ALL = CRA_NUMS + CRA_AMTS
CRA = f"""
cr0 AS (SELECT l_linenumber AS ln, l_quantity, l_extendedprice, l_partkey, l_suppkey, l_orderkey, c_custkey AS ck, c_nationkey AS nk,
        n_regionkey AS rk, CAST(year(o_orderdate) AS INTEGER) AS year
        FROM lineitem JOIN oc ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey),
cr1 AS (SELECT {code('nk')} AS FIPS,
        CASE WHEN ln IN (2, 3) THEN NULL ELSE substr({code('ck % 1000000', 6)}, 1, 4) || '.' || substr({code('ck % 1000000', 6)}, 5, 2) END AS tract,
        year, {code('ck % 4', 3)} AS income_group,
        CAST(CASE WHEN ln = 2 THEN 200 WHEN ln = 3 THEN 210 END AS DOUBLE) AS geog_level,
        CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS num_under_100k, CAST(ln AS DOUBLE) AS num_100k_250k,
        CAST(l_suppkey % 100 AS DOUBLE) AS num_250k_1m, CAST(l_partkey % 50 AS DOUBLE) AS num_business_1m,
        CAST(CAST(floor(l_extendedprice / 10) AS BIGINT) AS DOUBLE) * 1000 AS amount_under_100k,
        CAST(l_partkey % 997 AS DOUBLE) * 1000 AS amount_100k_250k,
        CASE WHEN l_orderkey % 1009 <> 0 THEN CAST(l_orderkey % 1000 AS DOUBLE) * 1000 END AS amount_250k_1m,
        CAST(CAST(floor(l_extendedprice) AS BIGINT) % 100000 AS DOUBLE) * 1000 AS amount_business_1m
        FROM cr0 WHERE ln NOT IN (1, 6)),
cra AS (SELECT *, amount_under_100k + amount_100k_250k + amount_250k_1m AS all_sb_loans FROM cr1)"""


def _cra_panel(entity: str, src: str, pop: str) -> str:
    sums = ", ".join(f"{ssum(m)} AS {m}" for m in CRA_ALL)
    defl = ", ".join(f"g.{m} * f.factor AS {m}" if m in CRA_AMTS else f"g.{m}" for m in CRA_ALL)
    pp = ", ".join(f"d.{m} / NULLIF(p.population, 0) AS {m}_pp" for m in CRA_ALL)
    return f"""
g AS (SELECT {entity}, year, {sums} FROM ({src}) GROUP BY {entity}, year),
d AS (SELECT g.{entity}, g.year, {defl} FROM g LEFT JOIN fac f ON g.year = f.year)
SELECT d.{entity}, d.year, {", ".join("d." + m for m in CRA_ALL)}, {pp}
FROM d LEFT JOIN {pop} p ON d.{entity} = p.{entity} AND d.year = p.year"""


GIVING = f"""
gv0 AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, '00' || {code('c_nationkey', 3)} AS FIPS,
        CASE WHEN year(o_orderdate) < 1998 THEN least(CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 4)
             ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS agi_stub,
        1.0::DOUBLE AS N1, o_totalprice AS A19700, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS N19700,
        c_acctbal AS A00100, CASE WHEN o_orderstatus <> 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS N04470, 1.0::DOUBLE AS N02650,
        o_totalprice + 500 AS A02650, CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS MARS1,
        CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE 1.0 END::DOUBLE AS MARS2,
        CASE WHEN year(o_orderdate) = 1996 THEN NULL ELSE 0.0 END::DOUBLE AS MARS4,
        CASE WHEN year(o_orderdate) = 1995 THEN NULL ELSE CAST(c_custkey % 3 AS DOUBLE) END AS NUMDEP
        FROM oc),
gv1 AS (SELECT {relabel()} AS FIPS, year,
        CASE WHEN year >= 1998 AND agi_stub >= 3 THEN agi_stub - 1 WHEN NOT (year >= 1998 AND agi_stub >= 3) THEN agi_stub END AS agi,
        N1 AS total_returns, A19700 * 1000 AS dollars_donated, N19700 AS num_giving, A00100 * 1000 AS agi_amt,
        N04470 AS number_itemized, N02650 AS income_num, A02650 * 1000 AS income_amt FROM gv0),
gv2 AS (SELECT gv1.* FROM gv1 JOIN peers p ON gv1.FIPS = p.FIPS WHERE p.current = 1),
gv3 AS (SELECT FIPS, year, agi, {", ".join(f"{ssum(m)} AS {m}" for m in ["total_returns", "dollars_donated", "num_giving", "agi_amt", "number_itemized", "income_num", "income_amt"])}
        FROM gv2 GROUP BY FIPS, year, agi),
gv4 AS (SELECT gv3.*, t.total_returns_city FROM gv3 JOIN (SELECT FIPS, year, {ssum('total_returns')} AS total_returns_city FROM gv3 GROUP BY FIPS, year) t
        ON gv3.FIPS = t.FIPS AND gv3.year = t.year),
panel AS (SELECT FIPS, year, agi,
          num_giving / NULLIF(total_returns, 0) * 100 AS donating_pct,
          dollars_donated / NULLIF(total_returns, 0) AS avg_giving_per_filer,
          dollars_donated / NULLIF(num_giving, 0) AS avg_giving_per_donor,
          agi_amt / NULLIF(total_returns, 0) AS avg_agi,
          income_amt / NULLIF(income_num, 0) AS avg_income,
          number_itemized / NULLIF(total_returns, 0) * 100 AS pct_itemized,
          (dollars_donated / NULLIF(total_returns, 0)) / NULLIF(agi_amt / NULLIF(total_returns, 0), 0) * 100 AS giving_pct_agi,
          (dollars_donated / NULLIF(total_returns, 0)) / NULLIF(income_amt / NULLIF(income_num, 0), 0) * 100 AS giving_pct_income,
          total_returns, total_returns / NULLIF(total_returns_city, 0) AS agi_pct FROM gv4)"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


_brackets = ", ".join("'" + b.replace("'", "''") + "'" for b in BRACKETS)

SQL: dict[str, str] = {}

SQL["q01_county_panel"] = w(DIMS, LOANS, COUNTY_7A) + "\nSELECT FIPS, year, sba_loan, total_loan, sba_loan_pp, total_loan_pp FROM c7"
SQL["q02_zip_panel"] = w(DIMS, LOANS, ZIP_7A) + "\nSELECT zip, year, sba_loan, total_loan, sba_loan_pp, total_loan_pp FROM z7"
SQL["q03_sparse_panel_complete"] = w(DIMS, LOANS, COUNTY_504) + "\nSELECT FIPS, year, total_504, total_504_pp FROM c5"
SQL["q04_zip_504_panel"] = w(DIMS, LOANS, ZIP_504) + "\nSELECT zip, year, total_504, total_504_pp FROM z5"
SQL["q05_bind_panels"] = w(DIMS, LOANS, COUNTY_7A, COUNTY_504) + """
SELECT FIPS, year, sba_loan, total_loan, total_504, sba_loan_pp, total_loan_pp, total_504_pp FROM c7 FULL OUTER JOIN c5 USING (FIPS, year)"""
SQL["q05_bind_inferred_keys"] = w(DIMS, LOANS, ZIP_7A, ZIP_504) + """
SELECT zip, year, sba_loan, total_loan, total_504, sba_loan_pp, total_loan_pp, total_504_pp FROM z7 FULL OUTER JOIN z5 USING (zip, year)"""
SQL["q06_clean_codes"] = w(DIMS, TX) + "\nSELECT transactionid, originalamount, FIPS, tract_10, tract_00, day, month, year, purpose FROM tx"
SQL["q07_cdfi_county"] = w(DIMS, TX, f"""
g AS (SELECT FIPS, year, {ssum('originalamount')} AS cdfi FROM tx WHERE FIPS IN (SELECT FIPS FROM peers) GROUP BY FIPS, year),
c AS (SELECT e.FIPS, y.year, coalesce(g.cdfi, 0.0) AS cdfi FROM (SELECT DISTINCT FIPS FROM g) e CROSS JOIN (SELECT DISTINCT year FROM g) y
      LEFT JOIN g ON g.FIPS = e.FIPS AND g.year = y.year),
m AS (SELECT FIPS, year, CASE WHEN count(cdfi) = count(*) THEN sum(cdfi) END AS cdfi FROM (SELECT {relabel()} AS FIPS, year, cdfi FROM c) GROUP BY FIPS, year)""") + """
SELECT m.FIPS, m.year, m.cdfi * f.factor AS cdfi, (m.cdfi * f.factor) / NULLIF(p.population, 0) AS cdfi_pp
FROM m LEFT JOIN fac f ON m.year = f.year LEFT JOIN pop_fips p ON m.FIPS = p.FIPS AND m.year = p.year"""
SQL["q08_msa_rollup"] = w(DIMS, TX, f"""
g AS (SELECT mc.MSA, tx.year, {ssum('tx.originalamount')} AS cdfi FROM tx LEFT JOIN msa_counties mc ON tx.FIPS = mc.FIPS GROUP BY mc.MSA, tx.year),
c AS (SELECT e.MSA, y.year, coalesce(g.cdfi, 0.0) AS cdfi FROM (SELECT DISTINCT MSA FROM g) e CROSS JOIN (SELECT DISTINCT year FROM g) y
      LEFT JOIN g ON g.MSA = e.MSA AND g.year = y.year)""") + """
SELECT c.MSA, c.year, c.cdfi * f.factor AS cdfi, (c.cdfi * f.factor) / NULLIF(p.population, 0) AS cdfi_pp
FROM c LEFT JOIN fac f ON c.year = f.year LEFT JOIN pop_msa p ON c.MSA = p.MSA AND c.year = p.year"""
SQL["q09_crosswalk_sum"] = w(DIMS, TX, CDFI_LAYERS) + "\nSELECT layer, area, year, cdfi, cdfi_pp FROM cl"
SQL["q10_fixed_width"] = w(DIMS, CRA) + f"\nSELECT FIPS, tract, year, income_group, geog_level, {', '.join(CRA_ALL)} FROM cra"
SQL["q10_fixed_width_by_file_order"] = SQL["q10_fixed_width"]
SQL["q11_cra_county"] = w(DIMS, CRA) + "," + _cra_panel(
    "FIPS", f"SELECT {relabel()} AS FIPS, year, {', '.join(CRA_ALL)} FROM cra WHERE geog_level = 200 AND FIPS IN (SELECT FIPS FROM peers)", "pop_fips"
)
SQL["q12_cra_msa"] = w(DIMS, CRA) + "," + _cra_panel(
    "MSA",
    f"SELECT mc.MSA, cra.year, {', '.join('cra.' + m for m in CRA_ALL)} FROM cra JOIN msa_counties mc ON cra.FIPS = mc.FIPS "
    "WHERE cra.geog_level = 200 AND cra.FIPS IN (SELECT FIPS FROM msa_counties WHERE MSA IN (SELECT MSA FROM peer_msa))",
    "pop_msa",
)
_wm = lambda m: f"sum(x.population * t.{m}) / nullif(sum(CASE WHEN t.{m} IS NOT NULL THEN x.population END), 0) AS {m}"
SQL["q13_crosswalk_weighted_mean"] = w(DIMS, CRA, f"""
t AS (SELECT '00011' || replace(tract, '.', '') AS tract, year, {ssum('amount_business_1m')} AS amount_business_1m, {ssum('all_sb_loans')} AS all_sb_loans
      FROM cra WHERE geog_level IS NULL AND FIPS = {HOME} AND year >= 1996 GROUP BY 1, year),
a AS (SELECT x.layer, x.neighborhood, t.year, {_wm('amount_business_1m')}, {_wm('all_sb_loans')} FROM t JOIN xw x ON t.tract = x.tract
      GROUP BY x.layer, x.neighborhood, t.year),
l AS (SELECT 'tract' AS layer, t.tract AS area, t.year, t.amount_business_1m, t.all_sb_loans,
             t.amount_business_1m / NULLIF(tp.pop, 0) AS amount_business_1m_pp, t.all_sb_loans / NULLIF(tp.pop, 0) AS all_sb_loans_pp
      FROM t LEFT JOIN tpop tp ON t.tract = tp.tract
      UNION ALL
      SELECT a.layer, a.neighborhood, a.year, a.amount_business_1m, a.all_sb_loans,
             a.amount_business_1m / NULLIF(ap.pop, 0), a.all_sb_loans / NULLIF(ap.pop, 0)
      FROM a LEFT JOIN apop ap ON a.layer = ap.layer AND a.neighborhood = ap.neighborhood)""") + """
SELECT l.layer, l.area, l.year, l.amount_business_1m * f.factor AS amount_business_1m, l.all_sb_loans * f.factor AS all_sb_loans,
       l.amount_business_1m_pp * f.factor AS amount_business_1m_pp, l.all_sb_loans_pp * f.factor AS all_sb_loans_pp
FROM l LEFT JOIN fac f ON l.year = f.year"""
SQL["q14_count_per_home_pop"] = w(DIMS, """
cnt AS (SELECT mz.MSA, count(*) AS fortune_1000 FROM supplier s LEFT JOIN msa_zips mz ON lpad(CAST(s.s_suppkey % 97 AS VARCHAR), 5, '0') = mz.zip GROUP BY mz.MSA),
pc AS (SELECT cnt.MSA, cnt.fortune_1000, lp.population, cnt.fortune_1000 / NULLIF(lp.population, 0) AS fortune_1000_pp
       FROM cnt LEFT JOIN pop_msa_latest lp ON cnt.MSA = lp.MSA WHERE cnt.MSA IN (SELECT MSA FROM peer_msa))""") + """
SELECT MSA, fortune_1000, population, fortune_1000_pp, fortune_1000_pp * (SELECT max(population) FROM pc WHERE MSA = '00001') AS fortune_1000_per_lou FROM pc"""
SQL["q15_deal_stats"] = w(DIMS, f"""
dl AS (SELECT mz.MSA, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN o_orderkey % 10 = 0 OR (year(o_orderdate) = 2001 AND c_nationkey % 5 = 4) THEN NULL ELSE o_totalprice END AS amount
       FROM oc LEFT JOIN msa_zips mz ON lpad(CAST(c_custkey % 97 AS VARCHAR), 5, '0') = mz.zip),
st AS (SELECT MSA, year, count(*) AS deals, count(amount) AS deals_amount,
       coalesce(CAST(sum(CAST(amount * 1000000 AS DECIMAL(28,4))) AS DOUBLE), 0.0) AS total_dollars
       FROM dl WHERE MSA IS NOT NULL GROUP BY MSA, year),
rk AS (SELECT MSA, year, amount, row_number() OVER (PARTITION BY MSA, year ORDER BY amount) AS rn,
       count(*) OVER (PARTITION BY MSA, year) AS n FROM dl WHERE MSA IS NOT NULL AND amount IS NOT NULL),
md AS (SELECT MSA, year, (min(amount) + max(amount)) / 2 AS median_deal FROM rk WHERE rn = (n + 1) // 2 OR rn = n // 2 + 1 GROUP BY MSA, year),
s2 AS (SELECT st.MSA, st.year, st.deals, st.total_dollars * f.factor AS total_dollars,
       (st.total_dollars / NULLIF(st.deals_amount, 0)) * f.factor AS avg_deal, (md.median_deal * 1000000) * f.factor AS median_deal
       FROM st LEFT JOIN md ON st.MSA = md.MSA AND st.year = md.year LEFT JOIN fac f ON st.year = f.year)""") + """
SELECT s2.MSA, s2.year, 'total' AS sex, 'total' AS race, s2.deals, s2.deals / NULLIF(p.population, 0) * 100000 AS deals_per_100000,
       s2.total_dollars, s2.total_dollars / NULLIF(p.population, 0) AS total_dollars_pc, s2.avg_deal, s2.median_deal
FROM s2 LEFT JOIN pop_msa_latest p ON s2.MSA = p.MSA"""
SQL["q16_bracket_panel"] = w(DIMS, GIVING) + "\nSELECT * FROM panel"
SQL["q16_schema_drift_union"] = w(DIMS, GIVING) + """
SELECT '00' AS STATEFIPS, substr(FIPS, 3, 3) AS COUNTYFIPS, agi_stub, N1, A19700, N19700, A00100, N04470, N02650, A02650, MARS1, MARS2, MARS4, NUMDEP, year FROM gv0"""
_metric_rows = " UNION ALL ".join(f"SELECT city, year, '{v}' AS variable, {k} AS rank FROM rc" for k, v in METRIC_LABELS.items())
SQL["q17_rank_two_metrics_long"] = w(DIMS, GIVING, f"""
r AS (SELECT FIPS, year, {rank_desc('donating_pct', 'year')} AS donating_pct, {rank_desc('giving_pct_income', 'year')} AS giving_pct_income
      FROM panel WHERE agi = 4),
rc AS (SELECT p.city, r.year, r.donating_pct, r.giving_pct_income FROM r JOIN peers p ON r.FIPS = p.FIPS),
lg AS ({_metric_rows})""") + f"""
SELECT city, year, variable, rank, CASE WHEN city = 'CITY_11' THEN '{HOME_COLOR}' ELSE '{OTHER_COLOR}' END AS color,
       CAST(CASE WHEN city = 'CITY_11' THEN 1.0 ELSE 0.8 END AS DOUBLE) AS alpha, concat_ws(' - ', city, CAST(rank AS VARCHAR)) AS label FROM lg"""
SQL["q18_home_vs_peer_table"] = w(DIMS, GIVING, f"""
t AS (SELECT agi, max(CASE WHEN FIPS = {HOME} THEN pct_itemized END) AS home_pct, {smean(f"FIPS <> {HOME}", 'pct_itemized')} AS peer_pct
      FROM panel WHERE year = 2000 GROUP BY agi)""") + f"""
SELECT agi, ([{_brackets}])[agi] AS bracket, round(home_pct, 9) AS home_pct, round(peer_pct, 9) AS peer_pct,
       {pct_text('home_pct')} AS home_text, {pct_text('peer_pct')} AS peer_text FROM t"""
SQL["q19_peer_gap"] = w(DIMS, GIVING, f"""
g AS (SELECT {smean(f"FIPS <> {HOME}", 'giving_pct_income')} AS peer, max(CASE WHEN FIPS = {HOME} THEN giving_pct_income END) AS home,
      max(CASE WHEN FIPS = {HOME} THEN avg_income END) AS income, max(CASE WHEN FIPS = {HOME} THEN total_returns END) AS cnt
      FROM panel WHERE agi = 4 AND year = 2000),
gg AS (SELECT peer - home AS percent_gap, (peer - home) / 100 * income * cnt AS dollar_gap FROM g)""") + f"""
SELECT round(percent_gap, 9) AS percent_gap, round(dollar_gap, 4) AS dollar_gap,
       {pct_text('percent_gap')} AS percent_gap_text, {dollar_text('dollar_gap')} AS dollar_gap_text FROM gg"""
SQL["q20_spending_rank"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS FIPS, c_acctbal AS local_spend, {rank_desc('c_acctbal')} AS rank FROM customer"""
_panel7 = w(DIMS, LOANS, COUNTY_7A)
SQL["q21_rank_latest"] = _panel7 + f"""
SELECT FIPS, year, total_loan_pp, {rank_desc('total_loan_pp')} AS rank FROM c7 WHERE year = (SELECT max(year) FROM c7)"""
SQL["q21_rank_year"] = _panel7 + f"""
SELECT FIPS, year, sba_loan_pp, {rank_desc('sba_loan_pp')} AS rank FROM c7 WHERE year = 1998"""
SQL["q21_rank_multi_year"] = _panel7 + f""",
m AS (SELECT FIPS, CASE WHEN count(total_loan_pp) = count(*) THEN avg(total_loan_pp) END AS v FROM c7 WHERE year IN (1998, 1999, 2000) GROUP BY FIPS)
SELECT FIPS, round(v, 9) AS total_loan_pp, {rank_desc('v')} AS rank FROM m"""
SQL["q21_trend"] = _panel7 + f"""
SELECT year, max(CASE WHEN FIPS = {HOME} THEN total_loan_pp END) AS home, round({smean(f"FIPS <> {HOME}", 'total_loan_pp')}, 9) AS peers
FROM c7 GROUP BY year"""
SQL["q21_trend_roll3"] = w(DIMS, LOANS, COUNTY_504, """
rl AS (SELECT FIPS, year, CASE WHEN count(total_504_pp) OVER wd = 3 THEN avg(total_504_pp) OVER wd END AS v FROM c5
       WINDOW wd AS (PARTITION BY FIPS ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""") + f"""
SELECT year, round(max(CASE WHEN FIPS = {HOME} THEN v END), 9) AS home, round({smean(f"FIPS <> {HOME}", 'v')}, 9) AS peers FROM rl GROUP BY year"""
SQL["q22_rebase_series"] = w(DIMS, f"""
s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {ssum('o_totalprice')} AS amount FROM orders GROUP BY 1)""") + """
SELECT s.year, s.amount, s.amount * f.factor AS real_amount FROM s LEFT JOIN fac f ON s.year = f.year"""
_bins = MAP_BINS
_bin = "CASE " + " ".join(
    f"WHEN v.cdfi_pp >= {lo} AND v.cdfi_pp {'<=' if i == len(_bins) - 2 else '<'} {hi} THEN {i}"
    for i, (lo, hi) in enumerate(zip(_bins, _bins[1:]))
) + " END"
SQL["q23_map_layers_binned"] = w(DIMS, TX, CDFI_LAYERS, """
areas AS (SELECT DISTINCT 'tract' AS layer, tract AS area FROM xw UNION ALL SELECT DISTINCT layer, neighborhood FROM xw)""") + f"""
SELECT a.layer, a.area, v.cdfi_pp, CAST({_bin} AS INTEGER) AS bin
FROM areas a LEFT JOIN (SELECT * FROM cl WHERE year = 2000) v ON a.layer = v.layer AND a.area = v.area"""
SQL["q24_first_match_replace"] = """
SELECT p_partkey,
       regexp_replace(upper(concat_ws(' ', p_type, p_name, 'ST.', p_brand)), 'ST.', 'SAINT') AS wildcard,
       regexp_replace(upper(concat_ws(' ', p_type, p_name, 'ST.', p_brand)), 'ST\\.', 'SAINT') AS literal,
       regexp_replace(concat_ws('.', p_type, CAST(p_size AS VARCHAR), p_brand), '\\.', '') AS undotted,
       lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(length(CAST(p_partkey AS VARCHAR)), 3) AS INTEGER), '0') AS padded,
       CASE WHEN spot IS NULL THEN t ELSE substr(t, 1, spot - 1) || 'Q' || substr(t, spot + 2) END AS doubled,
       'ST' || chr(10) || p_brand || ' SAINT ST8' AS one_line
FROM (SELECT *, list_filter(range(1, length(t)), lambda i: substr(t, CAST(i AS INTEGER), 1) = substr(t, CAST(i AS INTEGER) + 1, 1))[1] AS spot
      FROM (SELECT *, upper(concat_ws(' ', p_type, p_name, 'ST.', p_brand)) AS t FROM part))"""
SQL["q25_strict_vs_skipping_sum"] = f"""
WITH j AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, l_linenumber,
           CASE WHEN l_linenumber <> 7 AND l_quantity <= 45 THEN l_extendedprice END AS x
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT year, l_linenumber, count(*) AS n_rows, count(x) AS n_values, {ssum('x')} AS strict_total,
       coalesce(CAST(sum(CAST(x AS DECIMAL(22,4))) AS DOUBLE), 0.0) AS total0,
       CASE WHEN count(x) = count(*) THEN CAST(sum(CAST(x AS DECIMAL(22,4))) AS DOUBLE) / NULLIF(CAST(count(x) AS DOUBLE), 0) END AS strict_avg,
       count(CASE WHEN x > 50000 THEN 1 WHEN NOT (x > 50000) THEN 0 END) AS n_flagged
FROM j GROUP BY year, l_linenumber"""
SQL["q26_csv_na_roundtrip"] = SQL["q02_zip_panel"]
SQL["q26_table_roundtrip"] = SQL["q01_county_panel"]
SQL["q27_delimited_pruned_scan"] = """
SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, l_linenumber, l_quantity, l_extendedprice AS price, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem"""
_sig = "CASE WHEN r.total_loan_pp = 0 THEN r.total_loan_pp ELSE round(r.total_loan_pp * pow(10, 3 - floor(log10(abs(r.total_loan_pp))))) / pow(10, 3 - floor(log10(abs(r.total_loan_pp)))) END"
SQL["q28_label_text"] = _panel7 + f""",
r AS (SELECT FIPS, total_loan_pp, {rank_desc('total_loan_pp')} AS rank FROM c7 WHERE year = (SELECT max(year) FROM c7)),
s AS (SELECT r.FIPS, p.city, r.rank, {_sig} AS sig, r.total_loan_pp FROM r LEFT JOIN peers p ON r.FIPS = p.FIPS)
SELECT FIPS, city, rank, sig AS value_sig4, {dollar_text('sig', 1)} AS value_text, {pct_text('total_loan_pp / 10')} AS pct_text,
       concat_ws(' - ', city, CAST(rank AS VARCHAR)) AS label FROM s"""

SQL["q27_export_keeps_rows"] = """
SELECT CAST(l_orderkey AS DOUBLE) AS "order", CAST(l_linenumber AS INTEGER) AS line,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS shipped,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS supplier,
       CASE WHEN l_linenumber = 2 THEN CAST(l_quantity AS INTEGER) * 1000000.0
            ELSE CAST('0.' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS DOUBLE) END AS amount
FROM lineitem"""
_named = "sba_loan AS sba_loan_7a, total_loan AS total_loan_7a, total_504 AS total_loan_504, sba_loan_pp AS sba_loan_7a_pp, total_loan_pp AS total_loan_7a_pp, total_504_pp AS total_loan_504_pp"
SQL["q05_combined_results"] = f"""
SELECT 'sba_county' AS result, FIPS AS place, year, {_named} FROM ({SQL["q05_bind_panels"]})
UNION ALL SELECT 'sba_zip' AS result, zip AS place, year, {_named} FROM ({SQL["q05_bind_inferred_keys"]})"""
_xs = ", ".join(f"('{layer}', '{name}', {n}, {shift}, {part})" for layer, name, n, shift, part in [("nh", "NH", 7, 0, 1), ("nh", "NH", 7, 1, 2), ("nh", "NH", 7, 3, 3), ("muw", "MUW", 5, 0, 2), ("muw", "MUW", 5, 2, 4)])
SQL["q09_split_crosswalk"] = w(DIMS, TX, f"""
tr AS (SELECT tract_10 AS tract, year, {ssum('originalamount')} AS cdfi FROM tx WHERE starts_with(tract_10, {HOME}) GROUP BY tract_10, year),
kt AS (SELECT DISTINCT '00011' || {code('c_custkey % 1000000', 6)} AS tract, c_custkey % 1000000 AS k FROM customer WHERE c_nationkey = 11),
sx AS (SELECT tract, s.layer, s.name || CAST((k + s.shift) % s.n AS VARCHAR) AS neighborhood,
       CAST(CASE s.part WHEN 1 THEN k % 600 + 100 WHEN 2 THEN k % 250 + 1 WHEN 3 THEN 1000 - (k % 600 + 100) - (k % 250 + 1) ELSE 1000 - (k % 250 + 1) END AS DECIMAL(9,3)) AS share
       FROM kt, (VALUES {_xs}) s(layer, name, n, shift, part)),
cx AS (SELECT *, CAST(sum(share) OVER (PARTITION BY tract, layer ORDER BY neighborhood) AS DECIMAL(9,3)) AS hi FROM sx),
ax AS (SELECT lay.layer, cx.neighborhood, tr.year, CASE WHEN cx.tract IS NULL THEN CAST(tr.cdfi AS DECIMAL(20,4))
         ELSE round(CAST(tr.cdfi AS DECIMAL(20,4)) * cx.hi * CAST(0.001 AS DECIMAL(4,3)), 4) END AS hi_v,
         CASE WHEN cx.tract IS NULL THEN 0 ELSE round(CAST(tr.cdfi AS DECIMAL(20,4)) * CAST(cx.hi - cx.share AS DECIMAL(9,3)) * CAST(0.001 AS DECIMAL(4,3)), 4) END AS lo_v, tr.cdfi
       FROM tr CROSS JOIN (VALUES ('nh'), ('muw')) lay(layer) LEFT JOIN cx ON tr.tract = cx.tract AND cx.layer = lay.layer)""") + """
SELECT layer, neighborhood, year, CASE WHEN count(cdfi) = count(*) THEN CAST(sum(CAST(hi_v AS DECIMAL(22,4)) - CAST(lo_v AS DECIMAL(22,4))) AS DOUBLE) END AS cdfi, true AS whole
FROM ax GROUP BY layer, neighborhood, year"""
SQL["q08_checked_join"] = w(DIMS, TX) + f"""
SELECT mc.MSA, count(*) AS transactions, {ssum('tx.originalamount')} AS cdfi, (SELECT count(*) FROM tx) AS fact_rows, (SELECT count(*) FROM tx) AS joined_rows
FROM tx LEFT JOIN msa_counties mc ON tx.FIPS = mc.FIPS GROUP BY mc.MSA"""
_stack = lambda layer, name, cols: f"SELECT '{name}' AS result, area AS place, year, {cols} FROM l WHERE layer = '{layer}'"
SQL["q09_cdfi_results"] = f"""
WITH l AS ({SQL["q09_crosswalk_sum"]})
SELECT 'cdfi_county' AS result, FIPS AS place, year, cdfi, cdfi_pp FROM ({SQL["q07_cdfi_county"]})
UNION ALL SELECT 'cdfi_msa' AS result, MSA AS place, year, cdfi, cdfi_pp FROM ({SQL["q08_msa_rollup"]})
UNION ALL {" UNION ALL ".join(_stack(x, f"cdfi_{x}", "cdfi, cdfi_pp") for x in ("tract", "nh", "muw"))}"""
_cra_cols = ", ".join([*CRA_ALL, *[f"{m}_pp" for m in CRA_ALL]])
_layered = ["amount_business_1m", "all_sb_loans", "amount_business_1m_pp", "all_sb_loans_pp"]
_layer_cols = ", ".join(m if m in _layered else f"CAST(NULL AS DOUBLE) AS {m}" for m in [*CRA_ALL, *[f"{m}_pp" for m in CRA_ALL]])
SQL["q13_cra_results"] = f"""
WITH l AS ({SQL["q13_crosswalk_weighted_mean"]})
SELECT 'cra_county' AS result, FIPS AS place, year, {_cra_cols} FROM ({SQL["q11_cra_county"]})
UNION ALL SELECT 'cra_msa' AS result, MSA AS place, year, {_cra_cols} FROM ({SQL["q12_cra_msa"]})
UNION ALL {" UNION ALL ".join(_stack(x, f"cra_{x}", _layer_cols) for x in ("tract", "nh", "muw"))}"""
SQL["q10_byte_exact"] = """
SELECT translate(upper(substr(n_name, 1, 5)), 'AEIO', 'ÄÉÏØ') AS name, CAST(c_custkey AS BIGINT) AS custkey, round(c_acctbal, 2) AS acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
SQL["q26_self_overwrite"] = f"""
SELECT FIPS, year, total_loan * 2 * 2 AS total_loan, "by" FROM ({SQL["q01_county_panel"]}), (VALUES ('path'), ('name')) v("by") WHERE year >= 1998"""
SQL["q26_inferred"] = f"""
SELECT CAST(o_orderkey AS BIGINT) AS key, {code('o_custkey % 97')} AS code, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus = 'F' END AS done,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS DOUBLE) ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 3 = 0 THEN '12' ELSE o_orderpriority END AS mixed, CAST(NULL AS INTEGER) AS nothing,
       'bigint string boolean date double string boolean' AS kinds
FROM orders"""
SQL["q27_quoted_records"] = """
SELECT CAST(o_orderkey AS DOUBLE) AS "order",
       CASE WHEN o_orderkey % 5 = 0 THEN 'one,' || chr(10) || o_orderstatus || chr(10) || chr(10) || '"two" ' || o_orderpriority
            WHEN o_orderkey % 5 = 1 THEN '5" pipe ' || CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END AS note,
       CAST(o_custkey AS DOUBLE) AS customer,
       CASE WHEN o_orderkey % 7 = 0 THEN 'end' || chr(10) || CAST(o_orderkey AS VARCHAR) ELSE '6"' END AS last, CAST(s.skip AS INTEGER) AS skip
FROM orders, (VALUES (0), (2)) s(skip)"""
SQL["q15_venture_results"] = f"SELECT * FROM ({SQL['q15_deal_stats']}) WHERE deals > 1"
SQL["q16_giving_results"] = f"SELECT * REPLACE (CAST(year AS BIGINT) AS year, CAST(agi AS BIGINT) AS agi) FROM ({SQL['q16_bracket_panel']})"
