"""Records over several lines, found in parallel, against Python's csv module."""

import csv
import io
import os
import random

import pytest

from peerscope.sources.delimited import read_delimited
from peerscope.sources.records import read_records, spans_lines


@pytest.fixture(params=["24", "134217728"])
def splits(spark, request):
    """Splits of a few bytes, so that records run over many of them, and of a whole file."""
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)


def random_rows(rng, n):
    words = ["", "plain", "two words", "a,b", "line\nbreak", '"quoted"', 'say "x"\n\n', "\n", "é\nü", "end\n", 'a"b']
    return [[str(i), rng.choice(words), rng.choice(words)] for i in range(n)]


def as_csv(rows, end):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_several_files(spark, tmp_dir, splits, end):
    rng = random.Random(11)
    want = []
    for f in range(2):
        rows = random_rows(rng, 20)
        write(tmp_dir, f"{f}.csv", as_csv([["id", "x", "y"]] + rows, end))
        want += [(float(r[0]), r[1].strip(" \t") or None, r[2].strip(" \t") or None) for r in rows]
    got = [tuple(r) for r in read_delimited(spark, tmp_dir, "ncc").collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_title_lines_with_quotes(spark, tmp_dir, splits):
    """Titles are passed over by position, whatever they hold and however many splits they fill."""
    for f in range(2):
        write(tmp_dir, f"{f}.csv", 'The "report\nby "Bob", of 5" pipes\n\nid,note\n1,"a\nb"\n\n2,"c"\n3,6" wide\n4,"say ""hi""\n"\n')
    got = sorted((r.id, r.note) for r in read_delimited(spark, tmp_dir, "nc", skip=3).collect())
    assert got == sorted(2 * [(1.0, "a\nb"), (2.0, "c"), (3.0, '6" wide'), (4.0, 'say "hi"\n')])


def test_header_over_lines_and_names(spark, tmp_dir, splits):
    write(tmp_dir, "a.csv", 'id,"long\nname"\n1,"x\ny"\n2,z\n')
    got = sorted(tuple(r) for r in read_delimited(spark, tmp_dir, "nc", names=["id", "name"]).collect())
    assert got == [(1.0, "x\ny"), (2.0, "z")]
    df = read_delimited(spark, tmp_dir, "nc")
    assert df.columns == ["id", "long\nname"] and df.count() == 2


def test_other_header_in_a_later_file_stops_the_read(spark, tmp_dir):
    write(tmp_dir, "a.csv", 'id,x\n1,"p\nq"\n')
    write(tmp_dir, "b.csv", "id,y\n2,r\n")
    with pytest.raises(Exception, match="header is not"):
        read_delimited(spark, tmp_dir, "nc").collect()


def test_open_quote_at_the_end_of_a_file(spark, tmp_dir, splits):
    write(tmp_dir, "good.csv", 'id,x\n1,"p\nq"\n')
    write(tmp_dir, "bad.csv", 'id,x\n1,"p\nq\n2,r\n')
    with pytest.raises(ValueError, match="unbalanced quote.*bad.csv"):
        read_delimited(spark, tmp_dir, "nc")


def test_plain_files_take_the_plain_way(spark, tmp_dir):
    write(tmp_dir, "a.csv", 'id,x\n1,5" pipe\n2,"a,b"\n3,"6"" wide"\n')
    assert not spans_lines(spark, tmp_dir)
    assert sorted(tuple(r) for r in read_delimited(spark, tmp_dir, "nc").collect()) == [(1.0, '5" pipe'), (2.0, "a,b"), (3.0, '6" wide')]


def test_a_field_over_many_blocks_and_empty_files(spark, tmp_dir, splits):
    long = "\n".join(f"line {i}" for i in range(20))
    write(tmp_dir, "a.csv", f'1,"{long}"\n2,x\n')
    write(tmp_dir, "b.csv", "")
    write(tmp_dir, "c.csv", "\n\n3,y")
    rows = read_records(spark, tmp_dir).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.head, r.value) for r in rows) == [("a.csv", False, "2,x"), ("a.csv", True, f'1,"{long}"'), ("c.csv", True, "3,y")]


def test_text_fields_lose_blanks_at_their_ends(spark, tmp_dir):
    write(tmp_dir, "a.csv", 'id,code\n1,  pad \n2," in quotes\t"\n')
    assert sorted(r.code for r in read_delimited(spark, tmp_dir, "nc").collect()) == ["in quotes", "pad"]
