"""Dialects of delimited files and shapes of JSON files: right, or an error that names what is wrong."""

import csv
import io
import random

import pytest
from conftest import plan_of, rows

from millrace.operators.conform import ColumnSpec
from millrace.sources import dialect
from millrace.sources import files as sources

SPECS = [ColumnSpec(1, "name", "name"), ColumnSpec(2, "town", "town")]
PEOPLE = [("ann", "oslo"), ("bob", "rome")]


def write(path, text):
    path.write_text(text)
    return str(path)


def read(spark, path, **declared):
    return rows(sources.read_source(spark, str(path), SPECS, **declared))


@pytest.mark.parametrize(
    "text, want",
    [
        ("town,name\noslo,ann\nrome,bob\n", PEOPLE),  # another order
        ("NAME|town\nann|oslo\nbob|rome\n", PEOPLE),
        ("age;town;name\n7;oslo;ann\n8;rome;bob\n", PEOPLE),  # a further column
        ('town,name\n"oslo, no",ann\nrome,"b, o, b"\n', [("ann", "oslo, no"), ("b, o, b", "rome")]),
        ('ann,"x, y"\nbob,rome\n', [("ann", "x, y"), ("bob", "rome")]),
        ('"name","town"\n"a ""b"" c","d"\n"e","f ""g"""\n', [('a "b" c', "d"), ("e", 'f "g"')]),
        ('name,town\n"a \\"b, c",d\n', [('a "b, c', "d")]),
        ('name,town\n5" pipe,6" nail\n', [('5" pipe', '6" nail')]),  # quotes that open nothing
        ("﻿name,town\nann,oslo\n", [("ann", "oslo")]),
        ("name,town\nann,\n,\n", [("ann", None), (None, None)]),
        ("ann|a;b,c\nbob|d\n", [("ann", "a;b,c"), ("bob", "d")]),
        ("name\ttown\r\nann\toslo\r\n\r\n", [("ann", "oslo")]),
    ],
)
def test_detected(spark, tmp_path, text, want):
    path = tmp_path / "t.csv"
    path.write_bytes(text.encode())
    assert read(spark, path) == want


@pytest.mark.parametrize(
    "text, said",
    [
        ("name,town\nann,oslo,7\n", "2 to 3 cells"),
        ("ann,oslo,7\nbob,rome,8\n", "3 to 3 cells, not 2"),
        ('name,town\nann,"oslo\nno"\n', "end of a line"),
        ("name,town,NAME\na,b,c\n", "name twice"),
        ("ann,oslo|x\nbob,rome|y\n", "all fit"),
    ],
)
def test_conflicts_are_named(spark, tmp_path, text, said):
    with pytest.raises(ValueError, match=said):
        read(spark, write(tmp_path / "t.csv", text))


def test_files_of_several_orders(spark, tmp_path):
    (tmp_path / "a b+c").mkdir()  # names that are encoded in the metadata column
    for k, text in enumerate(["name,town\nann,oslo\n", "town,age,name\nrome,7,bob\n", "name,town\ncid,bern\n"]):
        write(tmp_path / "a b+c" / f"t {k}.csv", text)
    assert read(spark, tmp_path / "a b+c" / "*.csv") == [*PEOPLE, ("cid", "bern")]
    write(tmp_path / "a b+c" / "u.csv", "dan,lima\n")
    with pytest.raises(ValueError, match="some files have a header"):
        read(spark, tmp_path / "a b+c" / "*.csv")


def test_declared_parts_are_kept(spark, tmp_path):
    path = write(tmp_path / "t.csv", "name;town\nann;oslo\n")
    assert read(spark, path, header=False) == [("ann", "oslo"), ("name", "town")]
    assert read(spark, path, delimiter=";") == [("ann", "oslo")]
    with pytest.raises(ValueError, match="no header"):
        read(spark, write(tmp_path / "u.csv", "ann;oslo\n"), header=True)
    for k, text in enumerate(["name,town\nann,oslo\n", "town,name\nrome,bob\n"]):
        write(tmp_path / f"v{k}.csv", text)
    with pytest.raises(Exception, match="CSV header"):  # declared files are not looked into, but never swapped
        sources.read_source(spark, str(tmp_path / "v*.csv"), header=True, delimiter=",").collect()


def test_one_scan_without_sort(spark, tmp_path):
    path = write(tmp_path / "t.csv", "name,town\nann,oslo\n")
    lines = spark.read.text(path).selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS start", "1L AS line")
    plan = plan_of(dialect._profile(lines, ["name", "town"], [",", "|"]))
    assert plan.count("Scan text") == 2 and "Sort" not in plan  # once in the tree, once in the list of nodes


def test_random_files_against_the_csv_module(spark, tmp_path):
    random_ = random.Random(4)
    cells = ["a", "b c", "x, y", "p|q", "s;t", 'he said "no"', "~", "12.5"]
    for k in range(6):
        delimiter = random_.choice([",", "|", ";"])
        names = random_.sample(["name", "town", "age", "note"], 4)
        out = io.StringIO()
        writer = csv.writer(out, delimiter=delimiter, quoting=csv.QUOTE_ALL if k % 2 else csv.QUOTE_MINIMAL, lineterminator="\n")
        table = [[random_.choice(cells) for _ in names] for _ in range(40)]
        writer.writerows([names, *table])
        want = sorted(((r[names.index("name")], r[names.index("town")]) for r in table), key=repr)
        assert read(spark, write(tmp_path / f"t{k}.csv", out.getvalue())) == want


def test_json_files_of_both_shapes(spark, tmp_path):
    write(tmp_path / "a.json", '\n [{"a": 1},\n {"a": 2}]\n')
    write(tmp_path / "b.json", '{"a": 3}\n{"a": 4, "b": "x"}\n{"a": 5}\n')
    path = str(tmp_path / "*.json")
    assert rows(sources.read_source(spark, path, schema="a int")) == [(i,) for i in range(1, 6)]
    assert rows(sources.read_source(spark, path).select("a", "b")) == [(1, None), (2, None), (3, None), (4, "x"), (5, None)]
    arrays, lines = sources.json_shapes(spark, path)
    assert [f.rpartition("/")[2] for f in arrays] == ["a.json"] and [f.rpartition("/")[2] for f in lines] == ["b.json"]
    inner = write(tmp_path / "c.json", '{"a":\n[1,\n2]}\n[3]\n')  # a bracket further down makes no array
    assert sources.json_shapes(spark, inner)[0] == []
