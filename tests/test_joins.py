import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from millrace.operators import joins, windows


@pytest.fixture
def left(frame):
    return frame([(1, "a"), (2, "b"), (2, "bb"), (None, "n")], "k int, l string")


@pytest.fixture
def right(frame):
    return frame([(2, "x"), (2, "y"), (3, "z"), (None, "m")], "k int, r string")


def test_inner(left, right):
    expected = [(2, "b", "x"), (2, "b", "y"), (2, "bb", "x"), (2, "bb", "y")]
    assert rows(joins.join(left, right, "k")) == expected
    assert rows(joins.inner_join(left, right, ["k"])) == expected
    other = right.withColumnRenamed("k", "j")
    assert rows(joins.join(left, other, left_keys="k", right_keys="j")) == expected


def test_clashing_names_need_marks(left):
    with pytest.raises(ValueError):
        joins.join(left, left, "k")
    assert joins.join(left, left, "k", left_prefix="a_", right_prefix="b_").columns == ["k", "a_l", "b_l"]
    assert joins.inner_join(left, left, "k", ("_1", "_2")).columns == ["k", "l_1", "l_2"]


@pytest.mark.parametrize("hot", [False, True])
def test_left(left, right, hot):
    expected = rows(left.join(right, "k", "left").select("k", "l", "r"))
    assert rows(joins.left_join(left, right, "k", hot_right_keys=hot)) == expected
    other = right.withColumnRenamed("k", "j")
    both = joins.left_join_different_key_names(left, other, ["k"], ["j"], hot_right_keys=hot)
    assert both.columns == ["k", "l", "j", "r"]
    assert len(rows(both)) == len(expected)


@pytest.mark.parametrize("suffixes", [("", ""), ("_l", "_r")])
def test_full(left, right, suffixes):
    if suffixes[0]:
        left, right = left.withColumnRenamed("l", "v"), right.withColumnRenamed("r", "v")
    found = joins.outer_join(left, right, "k", suffixes)
    a, b = left.toDF("k", "p"), right.toDF("k", "q")
    assert rows(found) == rows(a.join(b, "k", "full").select("k", "p", "q"))
    assert len(found.columns) == 3


def test_full_with_unique_keys(frame):
    a = frame([(1, "a"), (2, "b")], "k int, l string")
    b = frame([(2, "x"), (3, "y")], "k int, r string")
    assert rows(joins.outer_join(a, b, "k", unique_keys=True)) == [(1, "a", None), (2, "b", "x"), (3, None, "y")]
    assert rows(joins.outer_join(a, b, "k")) == [(1, "a", None), (2, "b", "x"), (3, None, "y")]


def test_anti_and_semi_use_all_keys(frame):
    a = frame([(1, 1), (1, 2), (None, 1)], "p int, q int")
    b = frame([(1, 1), (1, 1)], "p int, q int")
    assert rows(joins.anti_join(a, b, ["p", "q"])) == [(1, 2), (None, 1)]
    assert rows(joins.semi_join(a, b, ["p", "q"])) == [(1, 1)]


def test_lookup_takes_the_first_by_order(left, right):
    found = joins.lookup_join(left, right, "k", order_by=[F.col("r").desc()])
    assert rows(found) == [(1, "a", None), (2, "b", "y"), (2, "bb", "y"), (None, "n", None)]
    with pytest.raises(ValueError):
        joins.lookup_join(left, right, "k")


def test_surrogate_key_lookup(frame):
    source = frame([("a", 1), ("z", 2)], "code string, v int")
    dimension = frame([("a", 10)], "nat string, sk int")
    found = joins.surrogate_key_lookup(source, dimension, ["nat"], "sk", "code_fk", ["code"])
    assert found.columns == ["v", "code_fk"]
    assert rows(found) == [(1, 10), (2, None)]


def test_enrich_reports_unmapped(frame):
    facts = frame([("x", 1), ("y", 2)], "country string, v int")
    countries = frame([("x", "X land")], "country string, name string")
    found, unmapped = joins.enrich(facts, [(countries, "country", {"name": "organisation"})], required=True)
    assert rows(found.select("v", "organisation")) == [(1, "X land"), (2, None)]
    assert rows(unmapped) == [("country", "y")]


def test_first_row_limits_before_the_shuffle(spark):
    data = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    found = windows.group_select_first(data, "k", ["id"])
    assert rows(found) == [(0, 0), (1, 1), (2, 2)]
    assert plan_of(found).count("WindowGroupLimit") >= 2


def test_equal_rows_are_chosen_the_same_way(spark):
    data = spark.range(2000).select((F.col("id") % 5).alias("k"), "id", F.lit(1).alias("o"))
    first = rows(windows.group_select_first(data, "k", ["o"]))
    assert first == rows(windows.group_select_first(data.repartition(11), "k", ["o"]))
    numbers = [windows.number_within_groups(data.repartition(n), "k", ["o"]) for n in (3, 7)]
    assert rows(numbers[0]) == rows(numbers[1])


def test_row_index_with_ties_and_nulls(spark):
    data = spark.range(0, 5000, numPartitions=7).select(F.when(F.col("id") % 5 > 0, F.lit("hot")).alias("k"), "id")
    indexed = windows.row_index(data, ["k"])
    assert [r[0] for r in indexed.select("row_index").orderBy("row_index").collect()] == list(range(1, 5001))
    assert indexed.filter("k is null").agg(F.max("row_index")).first()[0] == 1000
    assert windows.row_index(data.filter("id < 0"), ["id"]).count() == 0


def test_hot_values_spread_over_partitions(spark):
    """Rows with one value of the order column must not end in one partition."""
    data = spark.range(0, 20000, numPartitions=8).select(F.lit("hot").alias("k"), "id")
    spread = data.withColumn("__tie", F.xxhash64("k", "id")).repartitionByRange(8, "k", "__tie")
    sizes = [r[1] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 3


def test_number_within_groups(spark):
    data = spark.range(0, 3000).select(F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "warm").alias("k"), "id")
    numbered = windows.number_within_groups(data, "k", ["id"])
    for key, size in (("hot", 2100), ("warm", 600), (None, 300)):
        mine = numbered.filter(F.col("k").eqNullSafe(F.lit(key))).orderBy("id").select("row_number").collect()
        assert [r[0] for r in mine] == list(range(1, size + 1))


def test_positional_zip_and_add_column(frame):
    a = frame([("c",), ("a",), ("b",)], "x string")
    b = frame([(10,), (30,)], "y int")
    assert rows(windows.positional_zip(a, b, ["x"], ["y"])) == [("a", 10), ("b", 30)]
    assert rows(windows.add_column(a, "n", [1, 2, 3], "int", ["x"])) == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError):
        windows.positional_zip(a, b, [], ["y"])


def test_surrogate_keys_continue(frame):
    old = frame([(7, "a")], "id long, n string")
    new = frame([("c",), ("b",)], "n string")
    assert rows(windows.surrogate_keys(new, "n", "id", old)) == [(8, "b"), (9, "c")]


def test_latest_rows_keeps_ties_and_compares_numbers(frame):
    data = frame([(" a", "9"), ("a ", "10"), ("a", "10"), ("b", "x"), (None, "1")], "n string, v string")
    found = windows.latest_rows(data, F.trim("n"), F.col("v").try_cast("int"))
    assert rows(found) == [("a ", "10"), ("a", "10")] or rows(found) == [("a", "10"), ("a ", "10")]


def test_bridge(frame):
    links = frame([(1, "a", "x"), (1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, None, "x"), (5, "c", "x")], "id int, l string, r string")
    left = frame([("a", 1), ("b", 2), ("c", None)], "l string, g int")
    right = frame([("x", 1), ("y", 2)], "r string, g int")
    assert rows(joins.bridge(links, left, right, "l", "r")) == [("a", "x"), ("a", "y"), ("b", "x"), ("c", "x")]
    assert rows(joins.bridge(links, left, right, "l", "r", agree=["g"], keep=["id"])) == [(1, "a", "x")]
