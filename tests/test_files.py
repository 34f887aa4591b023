import gzip
import tracemalloc

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from millrace.operators.conform import ColumnSpec
from millrace.session import cluster_settings, scratch_path, shared_dir
from millrace.sinks import files as sinks
from millrace.sinks import tables
from millrace.sources import files as sources
from millrace.sources import jdbc, xmltags
from millrace.sources.tables import catalog_table, spark_sql
from millrace.streaming import kafka


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("delimiter", [",", "|", ";", "\t"])
def test_delimited(spark, tmp_path, delimiter):
    lines = [delimiter.join(p) for p in [("id", "name"), ("1", "ann"), ("2", "bob"), ("3", "cid")]]
    path = write(tmp_path / "t.csv", "\n".join(lines) + "\n")
    specs = [ColumnSpec(1, "id", "id"), ColumnSpec(2, "name", "name")]
    assert sources.detect_header_and_delimiter(spark, path, ["id", "name"]) == (True, delimiter)
    assert rows(sources.read_source(spark, path, header=True, delimiter=delimiter)) == [("1", "ann"), ("2", "bob"), ("3", "cid")]
    assert rows(sources.read_source(spark, path, specs)) == [("1", "ann"), ("2", "bob"), ("3", "cid")]


def test_headerless(spark, tmp_path):
    specs = [ColumnSpec(2, "name", "name"), ColumnSpec(1, "id", "id")]
    path = write(tmp_path / "t.pip", "1|ann\n2|bob\n")
    assert sources.read_source(spark, path, specs).columns == ["id", "name"]
    plain = write(tmp_path / "t.txt", "1,10\n2,20\n3,30\n")
    assert rows(sources.read_source(spark, plain, specs)) == [("1", "10"), ("2", "20"), ("3", "30")]


def test_headerless_delimiter_is_detected(spark, tmp_path):
    specs = [ColumnSpec(1, "id", "id"), ColumnSpec(2, "name", "name")]
    path = write(tmp_path / "s.pip", "1;ann\n2;bob\n")
    assert rows(sources.read_source(spark, path, specs)) == [("1", "ann"), ("2", "bob")]
    single = write(tmp_path / "one.pip", "ann\nbob\n")
    assert rows(sources.read_source(spark, single, specs[1:])) == [("ann",), ("bob",)]


def test_glob_reads_every_file(spark, tmp_path):
    for i in (1, 2):
        write(tmp_path / f"t_{i}.csv", f"id,name\n{i},n{i}\n{i}0,m{i}\n")
    assert sources.read_source(spark, str(tmp_path / "t_*.csv"), header=True).count() == 4


def test_xml(spark, tmp_path):
    path = write(tmp_path / "t.xml", "<all>\n<row><id>1</id></row>\n<row><id>2</id></row>\n</all>")
    assert sources.detect_row_tag(spark, path) == "row"
    assert rows(sources.read_source(spark, path)) == [(1,), (2,)]
    mixed = write(tmp_path / "m.xml", "<all>\n<row><id>1</id></row>\n<other/>\n</all>")
    with pytest.raises(ValueError):
        sources.detect_row_tag(spark, mixed)


def test_json_and_dispatch(spark, tmp_path):
    path = write(tmp_path / "t.json", '[{"a": 1},\n {"a": 2}]')
    assert rows(sources.read_json(spark, path, "a int", array_file=True)) == [(1,), (2,)]
    lines = write(tmp_path / "l.json", '{"a": 1}\n{"a": 2}\n')
    assert rows(sources.read_source(spark, lines, schema="a int")) == [(1,), (2,)]
    assert sources.extension_of("s3://b/p/t.CSV") == "csv" and sources.extension_of("/a/b.c/t") == ""
    with pytest.raises(ValueError):
        sources.read_source(spark, "/x/t.xlsx")


def test_target_read_back(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sources.read_target(spark, path) is None
    (tmp_path / "empty").mkdir()
    assert sources.read_target(spark, str(tmp_path / "empty")) is None
    sinks.write_table(spark.range(3), path, "final", "load_date", "2024-01-01")
    assert sources.read_target(spark, path, "load_date").columns == ["id"]


def test_latest_file_date(spark, tmp_path):
    for day in ("20240101", "20240301", "20231231"):
        write(tmp_path / f"d_t_{day}_reconciled.csv", "x")
    assert str(sources.latest_file_date(spark, str(tmp_path)).first()[0]) == "2024-03-01"


def test_series(spark, frame):
    text = '{"OrganizationName":"O","CurrencyName":"USD","AccountData":[{"AccountName":"A","AccountIdentifier":"1","Data":[{"FiscalYear":"2020","NativeAmount":1.5},{"FiscalYear":"2021","NativeAmount":2.5}]},{"AccountName":"B","AccountIdentifier":"2","Data":[]}]}'
    found = sources.flatten_series(frame([(text,), (None,)], "s string"), "s")
    assert rows(found) == [("2020", 1.5, "A", "1", "O", "USD"), ("2021", 2.5, "A", "1", "O", "USD")]


def test_final_write_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_landing(spark.range(5), path)
    sinks.write_final(spark.read.parquet(path).filter("id > 1"), path)
    assert rows(spark.read.parquet(path)) == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), path, "elsewhere")


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, n in (("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-02", 4)):
        sinks.write_partition(spark.range(n), path, "d", day, replace=True)
    assert rows(spark.read.parquet(path).groupBy(F.col("d").cast("string")).count()) == [("2024-01-01", 2), ("2024-01-02", 4)]
    sinks.write_partition(spark.range(1), path, "d", "2024-01-02")
    assert spark.read.parquet(path).count() == 7
    recent = sinks.keep_recent(spark.read.parquet(path), "d", "2024-01-03", 1)
    assert recent.count() == 5 and "PartitionFilters: [isnotnull(d" in plan_of(recent)
    assert sinks.purge(spark, path, "d", "2024-01-03", 1) == ["2024-01-01"]
    assert spark.read.parquet(path).count() == 5
    assert sinks.purge(spark, path, "d", "2024-01-03", 1) == []
    sinks.write_frame(spark.range(2), str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2


def test_feeds(spark, frame, tmp_path):
    feed = frame([("a", 1)], "`Full Name` string, n int")
    sinks.write_csv_feed(feed, str(tmp_path / "feed"))
    assert spark.read.csv(str(tmp_path / "feed"), header=True).columns == ["Full Name", "n"]
    sinks.write_config_per_app(frame([("x", 1), ("y", 2)], "app_name string, v int"), str(tmp_path / "conf"))
    assert (tmp_path / "conf" / "app_name=x").is_dir()
    assert spark.read.json(str(tmp_path / "conf")).count() == 2


def test_error_table(spark, frame, tmp_path):
    path = str(tmp_path / "errors")
    errors = frame([("r", 1, "2024-01-01")], "rule_id string, n int, run_dt string")
    sinks.write_errors(errors, path)
    sinks.write_errors(errors, path)
    assert spark.read.parquet(path).count() == 2
    assert dict(spark.read.parquet(path).dtypes)["n"] == "string"


def test_table_types():
    assert tables.table_type("DATETIME") == "TIMESTAMP"
    assert tables.table_type("string") == "STRING" and tables.table_type("string", 5) == "VARCHAR(5)"
    assert tables.table_type("decimal") == "DECIMAL(38,0)" and tables.table_type("decimal", 10, 2) == "DECIMAL(10,2)"
    assert tables.table_type("varchar", 3) == "VARCHAR(3)" and tables.table_type("bigint") == "BIGINT"
    with pytest.raises(ValueError):
        tables.table_type("char")


def test_external_table_and_partition_discovery(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.range(4).withColumn("d", (F.col("id") % 2).cast("string"))
    data.write.partitionBy("d").parquet(path)
    tables.create_table_like(data, "millrace_t", path, "d")
    assert spark.table("millrace_t").count() == 0
    tables.discover_partitions(spark, "millrace_t")
    assert catalog_table(spark, "millrace_t").count() == 4
    tables.create_view(spark, "millrace_v", "select * from millrace_t where d = '1'")
    assert spark.table("millrace_v").count() == 2
    specs = [ColumnSpec(1, "id", "id", "bigint"), ColumnSpec(2, "d", "d", "string")]
    tables.create_table_from_specs(spark, "millrace_t", specs, path, "d")
    assert spark.table("millrace_t").columns == ["id", "d"]
    tables.create_temporary_view(data, "millrace_w")
    assert spark.sql("select count(*) from millrace_w").first()[0] == 4
    spark.sql("drop view millrace_v")
    spark.sql("drop table millrace_t")
    assert spark.read.parquet(path).count() == 4


def test_sql_over_frames(spark):
    assert rows(spark_sql(spark, "select max(id) from {numbers}", numbers=spark.range(5))) == [(4,)]


def test_jdbc_options():
    database = jdbc.Database("postgres", "jdbc:postgresql://h/d", "u", "p")
    assert jdbc.query_options(database, "select 1") == {
        "url": "jdbc:postgresql://h/d", "driver": "org.postgresql.Driver", "user": "u", "password": "p",
        "fetchsize": "500000", "query": "select 1",
    }
    ranged = jdbc.partitioned_options(database, "select * from t", "id", 1, 100)
    assert ranged["dbtable"] == "(select * from t) t" and ranged["numPartitions"] == "5" and "query" not in ranged
    assert "ORDER BY a" in jdbc.numbered_query("select * from t", "a")
    assert jdbc.write_options(database, "t")["truncate"] == "true"
    assert jdbc.bounds_query("select * from t", "id").startswith("SELECT MIN(id)")


def test_kafka_payload_and_options(frame):
    data = frame([(1, None, "x")], "a int, b string, c string")
    assert kafka.payload(data).first()[0] == "1||x"
    assert kafka.scan_options("h:1", "t", "earliest")["endingOffsets"] == "latest"


def test_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    settings = cluster_settings(100 * 2**40, 4000)
    assert int(settings["spark.sql.shuffle.partitions"]) >= 800_000
    assert cluster_settings(1, 4)["spark.sql.shuffle.partitions"] == "8"


def test_detection_looks_at_all_files_and_never_eats_a_first_line(spark, tmp_path):
    specs = [ColumnSpec(1, "name", "name"), ColumnSpec(2, "town", "town")]
    texts = write(tmp_path / "texts.csv", "ann,oslo\nbob,rome\n")
    assert rows(sources.read_source(spark, texts, specs)) == [("ann", "oslo"), ("bob", "rome")]
    headed = write(tmp_path / "headed.csv", "name,town\nann,oslo\n")
    assert rows(sources.read_source(spark, headed, specs)) == [("ann", "oslo")]
    with pytest.raises(ValueError, match="some files"):
        sources.read_source(spark, str(tmp_path / "*.csv"), specs)
    with pytest.raises(ValueError):
        sources.read_source(spark, texts)
    quoted_cells = write(tmp_path / "quoted.txt", 'ann,"oslo, no"\nbob,rome\n')
    assert rows(sources.read_source(spark, quoted_cells, specs)) == [("ann", "oslo, no"), ("bob", "rome")]
    assert rows(sources.read_source(spark, quoted_cells, specs, header=False, delimiter=",")) == [("ann", "oslo, no"), ("bob", "rome")]


def test_row_tags_of_all_files(spark, tmp_path):
    many = "".join(f"<row><id>{i}</id></row>\n" for i in range(1500))
    write(tmp_path / "late.xml", f"<all>\n{many}<other/>\n</all>")
    with pytest.raises(ValueError, match="other"):
        sources.detect_row_tag(spark, str(tmp_path / "late.xml"))
    path = write(tmp_path / "named.xml", '<all xmlns="urn:x">\n<row><id>1</id></row>\n</all>')
    assert rows(sources.read_source(spark, path)) == [(1,)]


def test_json_array_is_recognised(spark, tmp_path):
    path = write(tmp_path / "a.json", '[{"a": 1},\n {"a": 2}]')
    assert rows(sources.read_source(spark, path, schema="a int")) == [(1,), (2,)]


def test_replaced_table_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_final(spark.range(3), path)
    sinks.write_final(spark.read.parquet(path).filter("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_row_tags_are_found_in_constant_memory(tmp_path):
    """A stream of 400 MB that is made as it is read."""
    record = b"<x:row a='1'><x:row>" + b"t" * 500 + b"</x:row><other/></x:row>\n"

    class Stream:
        left = 400 << 20

        def read(self, n):
            if self.left == 400 << 20:
                self.left -= 1
                return b"<?xml version='1.0'?><!-- <no> --><all xmlns:x='urn:x'>"
            if self.left <= 0:
                closing, self.left = (b"</all>" if self.left > -(1 << 40) else b""), -(1 << 41)
                return closing
            piece = record * (n // len(record))
            self.left -= len(piece)
            return piece

    tracemalloc.start()
    assert xmltags.TopTags().read(Stream()) == {"x:row"}
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()


def test_row_tags_of_odd_paths(spark, tmp_path):
    (tmp_path / "a b+c").mkdir()
    write(tmp_path / "a b+c" / "t 1.xml", "<a><n:b/><n:b/></a>")
    with gzip.open(tmp_path / "a b+c" / "t2.xml.gz", "wt") as out:
        out.write("<a><c/></a>")
    assert rows(xmltags.row_tags(spark, str(tmp_path / "a b+c"))) == [("c", 1), ("n:b", 1)]
    with pytest.raises(Exception, match="1000 different tags"):
        write(tmp_path / "many.xml", f"<a>{''.join(f'<t{i}/>' for i in range(1001))}</a>")
        xmltags.row_tags(spark, str(tmp_path / "many.xml")).collect()


def test_ranges_of_a_key_are_disjoint_and_complete(spark, frame):
    from datetime import date, datetime
    from decimal import Decimal

    keys = [("it's",), ("a",), ("a",), ("b",), (None,), ("zz",), ("'",)]
    kinds = {
        "string": keys, "int": [(3,), (1,), (1,), (None,), (9,)], "date": [(date(2024, 1, d),) for d in (1, 5, 5, 9)] + [(None,)],
        "timestamp_ntz": [(datetime(2024, 1, 1, h, 0, 0, 5),) for h in range(6)], "decimal(5,2)": [(Decimal("1.50"),), (Decimal("-2.25"),)], "double": [],
    }
    for kind, values in kinds.items():
        data = frame(values, f"k {kind}")
        for parts in (1, 2, 3, 50):
            lows = spark.sql(jdbc.bounds_by_rank_query("SELECT * FROM {data}", "k", parts), data=data).collect()
            found = jdbc.range_predicates("k", [r["low"] for r in lows])
            assert len(found) <= max(1, parts) and sum(data.filter(p).count() for p in found) == len(values)
            later = frame([(v,) for v, in values] + [(None,)], f"k {kind}")
            assert sum(later.filter(p).count() for p in found) == len(values) + 1
