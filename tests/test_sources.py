import math
import os


from peerscope.plans import cra, spending
from peerscope.sources.delimited import read_delimited
from peerscope.sources.files import list_entries, read_yearly
from peerscope.sources.fixed_width import Field, Layout, layout_by_year, parse_layouts, read_fixed_width

# fixed values: the local spending sheet and its published output (17 places)
SPENDING_SHEET = """,FIPS,General Fund spending per capita,General Fund tax burden per capita,Net gain for residents
"Grand Rapids, MI",26081,588.94,476.15,112.79
"Oklahoma City, OK",40109,593.93,432.86,161.07
"Charlotte, NC",37119,697.21,538.52,158.69
"Tulsa, OK",40143,729.54,446.8,282.74
"Greensboro, NC",37081,819.29,724.38,94.91
"Omaha, NE",31055,823.24,515.87,307.37
"Indianapolis, IN*",18097,825.6,637.22,188.38
"Louisville, KY*",21111,826.29,760.21,66.08
"Knoxville, TN",47093,1005.15,773.63,231.52
"Columbus, OH",39049,1032.45,803.87,228.58
"Kansas City, MO",29095,1034.91,681.19,353.72
"Memphis, TN",47157,1058.79,594.47,464.32
"Greenville, SC",45045,1073.62,558.69,514.93
"Cincinnati, OH",39061,1301.95,1124.03,177.92
"Nashville, TN*",47037,1424.74,1006.24,418.5
"St. Louis, MO",MERGED,1631.49,953.93,677.56
"Birmingham, AL",1073,1959.09,1579,380.09
"""
SPENDING_OUT = {
    "26081": 588.9399999999999, "40109": 593.93, "37119": 697.21, "40143": 729.54, "37081": 819.2900000000001,
    "31055": 823.24, "18097": 825.6, "21111": 826.2900000000001, "47093": 1005.15, "39049": 1032.45, "29095": 1034.91,
    "47157": 1058.79, "45045": 1073.62, "39061": 1301.95, "47037": 1424.74, "MERGED": 1631.49, "1073": 1959.09,
}


def test_spending_golden_and_rank(spark, tmp_dir):
    path = os.path.join(tmp_dir, "spending.csv")
    with open(path, "w") as f:
        f.write(SPENDING_SHEET)
    table = spending.read_spending(spark, path)
    assert table.columns == ["FIPS", "local_spend"]
    got = {r.FIPS: r.local_spend for r in table.collect()}
    assert got.keys() == SPENDING_OUT.keys()  # codes kept as written (1073 not padded)
    assert all(math.isclose(got[k], v, rel_tol=1e-9) for k, v in SPENDING_OUT.items())
    ranks = {r.FIPS: r.rank for r in spending.spending_rank(table).collect()}
    assert ranks["21111"] == 10 and ranks["1073"] == 1 and sorted(ranks.values()) == list(range(1, 18))


def _fw(rec: dict, layout: Layout) -> str:
    line = [" "] * layout.width
    for f in layout.fields:
        v = str(rec.get(f.name, ""))
        w = f.end - f.start + 1
        v = v.rjust(w) if f.type == "n" else v.ljust(w)
        line[f.start - 1 : f.end] = list(v[:w])
    return "".join(line)


def test_fixed_width_two_layouts_by_file_order(spark, tmp_dir):
    rec = {"table": "A1-1", "year": 2016, "FIPS": "21111", "MSA": "3114", "tract": "0001.00", "income_group": "001",
           "num_under_100k": 5, "amount_under_100k": 120, "num_100k_250k": 1, "amount_100k_250k": 200,
           "num_250k_1m": 0, "amount_250k_1m": "", "num_business_1m": 2, "amount_business_1m": 90}
    for i in range(6):
        lay = cra.OLD_LAYOUT if i < 4 else cra.NEW_LAYOUT
        r = dict(rec, year=2012 + i, geog_level=200 if i % 2 else "")
        with open(os.path.join(tmp_dir, f"f{i}.dat"), "w") as f:
            f.write(_fw(r, lay) + "\n" + _fw(dict(r, table="D1-1"), lay) + "\n")
    raw = cra.read_by_file_order(spark, tmp_dir)
    assert raw.count() == 12
    norm = cra.normalize(raw).orderBy("year").collect()
    assert [r.year for r in norm] == list(range(2012, 2018))
    assert norm[0].amount_under_100k == 120000 and norm[0].amount_250k_1m is None and norm[0].all_sb_loans is None
    assert [r.geog_level for r in norm][:2] == [None, 200.0]
    assert norm[5].tract == "0001.00" and norm[5].income_group == "001"
    one = parse_layouts(spark.read.text(tmp_dir), {"old": cra.OLD_LAYOUT, "new": cra.NEW_LAYOUT}, layout_by_year(6, 4, 2016))
    assert sorted(r.year for r in one.filter("table = 'A1-1'").collect()) == [float(y) for y in range(2012, 2018)]


def test_read_fixed_width_simple(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.txt")
    with open(p, "w") as f:
        f.write("AB  12\nCD    \n")
    lay = Layout((Field("k", 1, 2, "c"), Field("n", 3, 6, "i")))
    assert [(r.k, r.n) for r in read_fixed_width(spark, p, lay).collect()] == [("AB", 12), ("CD", None)]


def test_read_delimited_compact_types_and_titles(spark, tmp_dir):
    p = os.path.join(tmp_dir, "sheet.csv")
    with open(p, "w") as f:
        f.write("Report title\nid,amount,skip,when\n1,\"$1,200.50\",x,2020-01-02\n2,n/a,y,2020-02-03\n")
    df = read_delimited(spark, p, "in_D", skip=1)
    assert df.columns == ["id", "amount", "when"]
    rows = df.orderBy("id").collect()
    assert [(r.id, r.amount) for r in rows] == [(1, 1200.5), (2, None)]
    assert str(rows[0].when) == "2020-01-02"


def test_read_yearly_drift(spark, tmp_dir):
    files = {
        "a_2010.csv": "STATEFIPS,COUNTYFIPS,N1,mars1\n21,111,5,1\n",
        "b_2011.csv": "STATEFIPS,COUNTYFIPS,N1,MARS1,MARS4\n21,111,7,2,3\n",
    }
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    assert len(list_entries(spark, tmp_dir, "*.csv")) == 2
    df = read_yearly(spark, tmp_dir, ["STATEFIPS", "COUNTYFIPS", "N1", "mars1", "MARS1", "MARS4"], start_year=2010,
                     renames={"mars1": "MARS1"}, types={"N1": "double", "MARS1": "double", "MARS4": "double"})
    rows = {r.year: r for r in df.collect()}
    assert rows[2010].MARS1 == 1.0 and rows[2010].MARS4 is None and rows[2011].MARS4 == 3.0
    assert rows[2010].STATEFIPS == "21" and rows[2010].COUNTYFIPS == "111"
    assert "mars1" not in df.columns


def test_export_with_title_lines(spark, tmp_dir):
    from peerscope.plans.venture import read_export

    p = os.path.join(tmp_dir, "deals.csv")
    with open(p, "w") as f:
        f.write("Deal export\nGenerated for peers\n\n")
        f.write("Company Name,Deal ID,Company ID,Company Post Code,Deal Date,Deal Size,Type,Note\n")
        f.write("Acme,1,2,40202,2018-03-01,1.5,VC,x\nGamma,9,9,40204,,2,VC,z\nBeta,3,4,40203,2019-05-02,,VC,y\n")
    df = read_export(spark, p, "ccccDdcc", skip=3)
    rows = {r["Company Name"]: r for r in df.collect()}
    assert set(rows) == {"Acme", "Beta", "Gamma"} and rows["Gamma"]["Deal Date"] is None
    assert rows["Acme"]["Deal Size"] == 1.5 and rows["Beta"]["Deal Size"] is None
    assert str(rows["Beta"]["Deal Date"]) == "2019-05-02"


def test_institution_and_transaction_readers(spark, tmp_dir):
    from peerscope.plans import cdfi

    p = os.path.join(tmp_dir, "tx.csv")
    names = cdfi.TRANSACTION_COLUMNS + [f"other{i}" for i in range(42)]
    with open(p, "w") as f:
        f.write(",".join(names) + "\n")
        f.write(",".join(["7", "8", "\"$1,000\"", "NONE", "21111000100", "X", "01-JAN-15", "MICRO"] + ["z"] * 42) + "\n")
    tx = cdfi.read_transactions(spark, p)
    assert tx.columns == cdfi.TRANSACTION_COLUMNS
    r = tx.collect()[0]
    assert r.originalamount == 1000.0 and r.projectfipscode_2010 == "21111000100"
    assert len(cdfi.INSTITUTION_TYPES.ljust(cdfi.INSTITUTION_WIDTH, "_")) == 203


def test_write_many_and_na_roundtrip(spark, tmp_dir):
    from pyspark.sql import types as T

    from peerscope.sources.sinks import read_csv_na, write_many

    a = spark.createDataFrame([("t1", 2017, 1.5), ("t2", 2017, None)], "tract string, year int, v double")
    b = spark.createDataFrame([("A", 2017, None)], "neighborhood string, year int, v double")
    write_many({"x_tract": a, "x_nh": b}, tmp_dir)
    back = read_csv_na(spark, os.path.join(tmp_dir, "x_tract"), T.StructType(
        [T.StructField("tract", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("v", T.DoubleType())]))
    assert sorted((r.tract, r.v) for r in back.collect()) == [("t1", 1.5), ("t2", None)]
    raw = "".join(open(os.path.join(tmp_dir, "x_nh", f)).read() for f in os.listdir(os.path.join(tmp_dir, "x_nh")) if f.endswith(".csv"))
    assert "A,2017,NA" in raw


def test_layout_by_record_length(spark, tmp_dir):
    from peerscope.sources.fixed_width import layout_by_length

    rec = {"table": "A1-1", "year": 2011, "FIPS": "21111", "MSA": "3114", "tract": "0001.00", "income_group": "001",
           "geog_level": 200, "num_under_100k": 1, "amount_under_100k": 2, "num_100k_250k": 3, "amount_100k_250k": 4,
           "num_250k_1m": 5, "amount_250k_1m": 6, "num_business_1m": 7, "amount_business_1m": 8}
    p = os.path.join(tmp_dir, "mixed.dat")
    with open(p, "w") as f:
        f.write(_fw(rec, cra.OLD_LAYOUT) + "\n" + _fw(dict(rec, year=2016, MSA="31140"), cra.NEW_LAYOUT) + "\n")
    out = cra.read_by_selector(spark, p, layout_by_length({91: "old", 116: "new"})).orderBy("year").collect()
    assert [(r.year, r.MSA, r.amount_business_1m) for r in out] == [(2011.0, "3114", 8.0), (2016.0, "31140", 8.0)]
