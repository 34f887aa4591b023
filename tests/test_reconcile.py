from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import reconcile


def tables(frame):
    schema = "id int, name string, age int"
    source = frame([(1, "a", 1), (2, "b", None), (3, "c", 3), (5, "e", 5)], schema)
    target = frame([(1, "a", 1), (2, "B", 2), (3, "c", 4), (6, "f", 6)], schema)
    return source, target


def test_cells(frame):
    source, target = tables(frame)
    found = reconcile.cell_mismatches(source, target, "id")
    assert rows(found) == [(2, "B", 2, ["name", "age"]), (3, "c", 4, ["age"])]
    literal = reconcile.cell_mismatches(source, target, "id", null_safe=False)
    assert rows(literal.select("id", "column_names")) == [(2, ["name"]), (3, ["age"])]
    assert rows(reconcile.sampled_mismatches(source, target, "id", 10)) == rows(found)
    assert reconcile.sampled_mismatches(source, target, "id", 1).count() <= 1


def test_both_directions(frame):
    source, target = tables(frame)
    sides = [r["side"] for r in reconcile.two_way_difference(source, target).collect()]
    assert sorted(sides) == ["source"] * 3 + ["target"] * 3
    assert rows(reconcile.key_presence(source, target, "id")) == [(1, "both"), (2, "both"), (3, "both"), (5, "source"), (6, "target")]
    assert reconcile.no_mismatch(source, target).first()["no_mismatch"] is False
    assert reconcile.no_mismatch(source, source).first()["no_mismatch"] is True


def test_full_key_tells_null_apart(frame):
    data = frame([("a", None), (None, "a"), ("ab", ""), ("a", "b")], "p string, q string")
    assert reconcile.full_row_key(data).select("full_key").distinct().count() == 4
    assert reconcile.full_row_key(data).filter(F.col("full_key").isNull()).count() == 0


def test_metadata(frame):
    source, target = tables(frame)
    inventory = reconcile.schema_inventory(source, target.withColumn("age", F.col("age").cast("string")), [("id", "id"), ("name", "name"), ("age", "age")])
    found = {r["source_column_name"]: r["matching"] for r in reconcile.metadata_check(inventory).collect()}
    assert found == {"id": True, "name": True, "age": False}
