"""Yearly files: one scan per header, the year by file."""

import os

import pytest
from test_building import scans_of

from peerscope.sources.files import by_header, read_yearly


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_two_hundred_files_with_three_headers(spark, tmp_dir):
    headers = ["code,a,b", "code,A,b", "code,b"]
    want = set()
    for i in range(200):
        row = {"code": f"{i:03d}", "a": None if i % 3 == 2 else str(i), "b": str(-i)}
        values = [row["code"], *([row["a"]] if row["a"] else []), row["b"]]
        put(tmp_dir, f"f {i:03d}.csv", headers[i % 3] + "\n" + ",".join(values) + "\n")
        want.add((row["code"], row["a"] and float(row["a"]), float(row["b"]), 1900 + i))
    df = read_yearly(spark, tmp_dir, ["code", "a", "b"], start_year=1900, renames={"A": "a"}, types={"a": "double", "b": "double"})
    got = []
    assert scans_of(spark, lambda: got.extend(df.collect())) == 3
    assert {(r.code, r.a, r.b, r.year) for r in got} == want


def test_folders_of_parts_years_by_name_and_line_breaks(spark, tmp_dir):
    put(tmp_dir, "y1/part-0.csv", 'k,v\n1,"two\nlines"\n')
    put(tmp_dir, "y1/part-1.csv", "k,v\n2,x\n")
    put(tmp_dir, "y1/_SUCCESS", "")
    put(tmp_dir, "y2.csv", "k\n3\n")
    got = read_yearly(spark, tmp_dir, ["k", "v"], years={"y1": 2010, "y2.csv": 2017}).collect()
    assert {(r.k, r.v, r.year) for r in got} == {("1", "two\nlines", 2010), ("2", "x", 2010), ("3", None, 2017)}


def test_headers_are_read_from_the_first_lines(spark, tmp_dir):
    put(tmp_dir, "a.csv", 'x,"y\nz"\n1,2\n')
    put(tmp_dir, "b.csv", "")
    assert list(by_header(spark, [os.path.join(tmp_dir, f) for f in ("a.csv", "b.csv")])) == [("x", "y\nz")]


def test_no_files(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_yearly(spark, tmp_dir, ["k"], start_year=2000)
