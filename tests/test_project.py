import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.columns import (
    catalog_type_name,
    cast_or_null,
    community_name,
    decimal_part,
    drop_last,
    first_meaningful,
    seconds_of,
    type_family,
)
from millrace.operators import project
from millrace.operators.conform import ColumnSpec, conform, source_names, specs_in_sequence, unparsed_cells
from pyspark.sql import types as T


@pytest.fixture
def people(frame):
    return frame([(1, "a", 1.5), (2, None, float("nan")), (3, "c", None)], "id int, name string, amount double")


def test_select_rename_drop(people):
    assert project.get_columns(people, ["name", "id"]).columns == ["name", "id"]
    assert project.get_columns(people, "name", "id").columns == ["name", "id"]
    assert project.rename(people, {"id": "key", "absent": "x"}).columns == ["key", "name", "amount"]
    assert project.cut_out(people, ["name", "absent"]).columns == ["id", "amount"]
    assert project.reorder_columns_to_match_target(people, people.select("amount", "id")).columns == ["amount", "id"]


def test_drop_na_columns_counts_nan(people, frame):
    assert project.drop_na_columns(people, "any").columns == ["id"]
    empty = people.withColumn("none", F.lit(None).cast("string"))
    assert project.drop_na_columns(empty, "all").columns == ["id", "name", "amount"]
    assert project.null_counts(people).first().asDict() == {"id": 0, "name": 1, "amount": 2}
    with pytest.raises(ValueError):
        project.drop_na_columns(people, "some")


def test_drop_na_columns_of_an_empty_table(people):
    nobody = people.filter("id < 0")
    assert project.drop_na_columns(nobody, "any").columns == people.columns
    assert project.drop_na_columns(nobody, "all").columns == []


def test_constants_and_computed(people):
    added = project.add_fields(project.add_field(people, "zone", "raw"), [["v", 1], ["w", None]])
    assert rows(added.select("id", "zone", "v", "w"))[0] == (1, "raw", 1, None)
    assert rows(project.add_computed_field(people, "n", "id + 1").select("n")) == [(2,), (3,), (4,)]
    doubled = project.add_computed_field(people, "n", lambda x: x * 2, ["id"], "int")
    assert rows(doubled.select("n")) == [(2,), (4,), (6,)]
    with pytest.raises(ValueError):
        project.add_computed_field(people, "n", lambda x: x, ["id"])


def test_conversion_returns_the_new_frame(frame):
    texts = frame([("1", "x"), ("1.5", "2"), (None, "99999999999")], "a string, b string")
    changed = project.conversion(texts, ["a", "b"], lambda c: c, "int")
    assert rows(changed) == [(1, None), (None, 2), (None, None)]
    lengths = project.conversion(texts, "a", lambda v: None if v is None else len(v), "int", python=True)
    assert rows(lengths.select("a")) == [(1,), (3,), (None,)]
    with pytest.raises(KeyError):
        project.conversion(texts, "absent", lambda c: c, "int")


def test_casts(frame):
    texts = frame([("1", "2.5", 3)], "a string, b string, c int")
    done = project.convert_column_to_string(
        project.convert_column_to_float(project.convert_column_to_int(texts, "a"), "b"), "c"
    )
    assert [t for _, t in done.dtypes] == ["int", "float", "string"]
    assert rows(done) == [(1, 2.5, "3")]


def test_cast_or_null_agrees_with_try_cast(frame):
    texts = frame([(t,) for t in ["1", " 2 ", "+3", "-4", "5.0", "", None, "x", "99999999999", "true", "N", "2024"]], "t string")
    for kind in ("int", "bigint", "smallint", "boolean"):
        both = texts.select(cast_or_null(F.col("t"), kind, T.StringType()).alias("a"), F.col("t").try_cast(kind).alias("b"))
        assert both.filter("NOT (a <=> b)").count() == 0, kind


def test_conditional_conversion_keeps_rows(frame):
    data = frame([(1, "A", True), (1, "A", True), (2, "B", None), (3, "C", False)], "id int, t string, c boolean")
    changed = project.conditional_conversion(data, "t", F.lower, F.col("c"))
    assert rows(changed.select("id", "t")) == [(1, "a"), (1, "a"), (2, "B"), (3, "C")]
    by_function = project.conditional_conversion(data, "t", lambda v: v.lower(), "c", "string")
    assert rows(by_function.select("id", "t")) == [(1, "a"), (1, "a"), (2, "B"), (3, "C")]


def test_first_meaningful(frame):
    data = frame([("NR", "", "x"), (None, "nan", None), ("a", "b", "c")], "p string, q string, r string")
    assert rows(data.select(first_meaningful("p", "q", "r"))) == [("a",), ("x",), (None,)]


def test_stringify_and_technical_columns(frame):
    data = frame([(1, float("nan"), None)], "a int, b double, op string").withColumn("rno", F.lit(7))
    assert rows(project.stringify(data)) == [("1", None, None, "7")]
    assert project.drop_technical_columns(data, "op").columns == ["a", "b"]


def test_conform(frame):
    data = frame([("7", "20240131", "x", "1.239", "UPD"), ("y", "bad", "z", None, None)], "n string, d string, s string, m string, op string")
    specs = [
        ColumnSpec(10, "m", "money", "decimal", 6, 2),
        ColumnSpec(2, "d", "day", "date", source_datetime_format="yyyyMMdd"),
        ColumnSpec(1, "n", "number", "int"),
        ColumnSpec(9, "s", "text", "varchar"),
        ColumnSpec(11, "d", "at", "timestamp", source_datetime_format="yyyyMMdd"),
    ]
    done = conform(data, specs, "op")
    assert done.dtypes == [
        ("number", "int"), ("day", "date"), ("text", "string"), ("money", "decimal(6,2)"), ("at", "timestamp"), ("op", "string"),
    ]
    assert [str(v) for v in done.filter("op = 'UPD'").first()][:4] == ["7", "2024-01-31", "x", "1.24"]
    assert done.filter("op is null").first()[:2] == (None, None)
    assert source_names(specs) == ["n", "d", "s", "m", "d"]
    lost = dict(tuple(r) for r in unparsed_cells(data, specs).collect())
    assert lost == {"number": 1, "day": 1, "text": 0, "money": 0, "at": 1}


def test_conform_dates(spark, frame):
    data = frame([("2024-01-31 10:20:30.5", "31/01/2024")], "a string, b string").withColumn("t", F.col("a").cast("timestamp"))
    specs = [
        ColumnSpec(1, "a", "seconds", "timestamp", target_datetime_format="yyyy-MM-dd HH:mm:ss"),
        ColumnSpec(2, "t", "minutes", "datetime", source_datetime_format="ignored", target_datetime_format="yyyy-MM-dd HH:mm"),
        ColumnSpec(3, "t", "day", "date", target_datetime_format="yyyyMMdd"),
        ColumnSpec(4, "b", "read", "date", target_datetime_format="dd/MM/yyyy"),
        ColumnSpec(5, "b", "none", "date", source_datetime_format="yyyyMMdd", target_datetime_format="dd/MM/yyyy"),
        ColumnSpec(6, "b", "at", "timestamp", source_datetime_format="dd/MM/yyyy"),
    ]
    found = conform(data, specs).select(*[F.col(s.target_column_name).cast("string") for s in specs]).first()
    assert tuple(found) == ("2024-01-31 10:20:30", "2024-01-31 10:20:00", "2024-01-31", "2024-01-31", None, "2024-01-31 00:00:00")


def test_specs_from_records_and_order(frame):
    record = {"sequence_number": "10", "source_column_name": "a", "target_column_name": "b", "target_datatype": "decimal", "target_length": "5", "target_precision": ""}
    spec = ColumnSpec.from_record(record)
    assert (spec.sequence_number, spec.target_length, spec.target_precision) == (10, 5, None)
    inventory = frame([("10",), ("9",)], "sequence_number string")
    assert [r[0] for r in specs_in_sequence(inventory).collect()] == ["9", "10"]


@pytest.mark.parametrize(
    "name, label",
    [
        ("bigint", "Whole Number"), ("smallint", "Whole Number"), ("int", "Whole Number"), ("string", "Text"),
        ("varchar", "Text"), ("char", "Text"), ("timestamp", "Date Time"), ("datetime", "Date Time"),
        ("date", "Date"), ("double", "Decimal Number"), ("decimal", "Decimal Number"), ("boolean", "True/False"),
    ],
)
def test_catalog_type_names(frame, name, label):
    assert frame([(name,)], "t string").select(catalog_type_name("t")).first()[0] == label


def test_small_functions(frame):
    one = frame([("decimal(10,2)", "esg", "elsewhere", "01:02:03", "abc", "a", "VARCHAR2")], "d string, e string, o string, c string, s string, x string, f string")
    found = one.select(
        decimal_part("d", 1), decimal_part("d", 2), community_name("e"), community_name("o"), seconds_of("c"),
        drop_last("s", 2), drop_last("x", 2), type_family("f"), type_family("o"), decimal_part("e", 1),
    ).first()
    assert tuple(found) == ("10", "2", "DataLake_ESG", "elsewhere", 3723, "a", "", "string", "date", None)


def test_texts_with_decimals_as_whole_numbers(frame):
    texts = ["12.7", "-12.7", " 3 ", "+4.", ".5", "1e3", "x", "", None, "2147483648", "99999999999999999999"]
    found = project.convert_column_to_int(frame([(k, v) for k, v in enumerate(texts)], "k int, v string"), "v")
    assert [r["v"] for r in found.orderBy("k").collect()] == [12, -12, 3, 4, 0, None, None, None, None, None, None]
    assert rows(project.convert_column_to_int(frame([(12.7,), (None,)], "v double"), "v")) == [(12,), (None,)]
