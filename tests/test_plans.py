import json
from dataclasses import replace
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.conform import ColumnSpec
from millrace.operators.joins import inner_join, outer_join
from millrace.operators.project import rename
from millrace.plans import bonds, catalog, ingest, lineage, methodology, pipelines
from millrace.plans.pipelines import FAILURE, SUCCESS, PipelineSpec
from millrace.session import cut
from millrace.sources import jdbc
from millrace.sources.files import read_target


# --- pipelines


def test_versions_compare_as_numbers(frame):
    inventory = frame(
        [("p", "9", ""), ("p", "10", None), ("p", "11", "false"), ("q", "1", "true"), ("r", "1", "false")],
        "pipeline_id string, version_number string, active string",
    )
    assert rows(pipelines.latest_active_versions(inventory)) == [("p", "10"), ("q", "1")]
    assert rows(pipelines.latest_active_versions(inventory, as_text=True)) == [("p", "9"), ("q", "1")]


def test_selection_reports_unknown(frame):
    inventory = frame([("p", 1), ("q", 2)], "pipeline_id string, v int")
    found, unknown = pipelines.select_pipelines(inventory, ["p", "z"])
    assert rows(found) == [("p", 1)] and rows(unknown) == [("z",)]
    versions = frame([("p", "3"), ("q", "4")], "pipeline_id string, version_number string")
    found, unknown = pipelines.select_pipelines(versions, ["p", "q"], "3")
    assert rows(found) == [("p", "3")] and rows(unknown) == [("q",)]


def test_status(spark):
    first = pipelines.status_row(spark, pipeline_id="p", execution_id="1", execution_start_dttm="2024-01-01 00:00:00", execution_end_dttm="a", job_status=SUCCESS)
    again = pipelines.status_row(spark, pipeline_id="p", execution_id="1", execution_start_dttm="2024-01-01 00:00:00", execution_end_dttm="b", job_status=FAILURE)
    other = pipelines.status_row(spark, pipeline_id="p", execution_id="2", execution_start_dttm="2024-01-02 00:00:00", execution_end_dttm="a", job_status=SUCCESS)
    status = pipelines.update_status(first.union(other), again.union(first))
    assert rows(status.select("execution_id", "job_status")) == [("1", FAILURE), ("2", SUCCESS)]
    assert pipelines.watermark(status, "p") == "2024-01-02 00:00:00"
    assert pipelines.watermark(status, "q") == "1900-01-01 00:00:00"
    assert rows(pipelines.last_success(again, "pipeline_id", "execution_start_dttm", "job_status")) == [("p", "1900-01-01 00:00:00")]
    with pytest.raises(KeyError):
        pipelines.status_row(spark, colour="red")


def test_blackout(frame):
    noon = datetime(2024, 1, 1, 12, 0, 0)
    assert pipelines.blackout_now("11:00:00 - 12:00:00", noon) and not pipelines.blackout_now("", noon)
    assert not pipelines.blackout_now("13:00:00-14:00:00", noon)
    data = frame([("11:00:00 - 12:00:00", noon), ("", noon), (None, noon)], "o string, t timestamp")
    assert [r[0] for r in data.select(pipelines.in_blackout("o", "t")).collect()] == [True, False, False]


def test_environments(frame):
    text = '[{"environment_name": "dev", "target_bucket_name": "d"}, {"environment_name": "PRD", "target_bucket_name": "p", "x": null}]'
    data = frame([(text,), (None,)], "e string")
    assert [r[0] for r in data.select(pipelines.storage_location("e", "prd")).collect()] == ["s3://p/data/final", None]
    assert data.select(pipelines.storage_location("e", "qa")).first()[0] is None


def test_configs(frame):
    fields = pipelines.PIPELINE_COLUMN_FIELDS
    schema = "pipeline_id string, version_number string, " + ", ".join(f"{f} string" for f in fields)
    columns = frame(
        [("p", "1", n, f"s{n}", *[None] * 4, f"t{n}", *[None] * 5) for n in ("10", "9")] + [("q", "1", "1", *[None] * 11)], schema
    )
    inventory = frame([("p", "1", {"a": "b"}), ("q", "2", None)], "pipeline_id string, version_number string, extra map<string,string>")
    found = pipelines.pipeline_configs(inventory, columns, 1000).collect()
    assert len(found) == 1 and found[0]["extra"] == '{"a":"b"}'
    assert [c["sequence_number"] for c in json.loads(found[0]["pipeline_columns"])] == ["9", "10"]


# --- ingest


@pytest.fixture
def pipeline(tmp_path):
    spec = PipelineSpec("p", target_path=str(tmp_path / "final"), landing_path=str(tmp_path / "landing"), load_type="delta", primary_key=("id",), sla="23:00:00", cdc_timestamp_columns=("changed",))
    specs = [ColumnSpec(1, "i", "id", "int"), ColumnSpec(2, "v", "v", "string")]
    return spec, specs


def test_two_runs(spark, frame, pipeline):
    spec, specs = pipeline
    schema = "i string, v string, changed timestamp_ntz"
    early, late = datetime(2024, 1, 1), datetime(2024, 2, 1)
    first = ingest.run_pipeline(spark, spec, specs, frame([("1", "a", early), ("2", "b", early)], schema), None, datetime(2024, 1, 2))
    outcome = first.first()
    assert (outcome["job_status"], outcome["landing_count"], outcome["final_count"], outcome["sla_met"]) == (SUCCESS, 2, 2, "true")
    source = frame([("1", "a", early), ("2", "B", late), ("x", "bad", late)], schema)
    second = ingest.run_pipeline(spark, spec, specs, source, first, datetime(2024, 2, 2)).first()
    assert (second["landing_count"], second["final_count"]) == (2, 3)
    assert rows(read_target(spark, spec.target_path)) == [(1, "a"), (2, "B"), (None, "bad")]


def test_empty_increment_and_failure(spark, frame, pipeline):
    spec, specs = pipeline
    nothing = frame([], "i string, v string, changed timestamp_ntz")
    outcome = ingest.run_pipeline(spark, spec, specs, nothing, None, datetime(2024, 1, 2)).first()
    assert (outcome["job_status"], outcome["landing_count"], outcome["final_count"]) == (SUCCESS, 0, 0)
    assert read_target(spark, spec.target_path) is None
    broken = ingest.run_pipeline(spark, spec, [ColumnSpec(1, "absent", "a")], frame([("1", "a", datetime(2024, 1, 1))], "i string, v string, changed timestamp_ntz"), None, datetime(2024, 1, 2)).first()
    assert broken["job_status"] == FAILURE and broken["error_message"]
    resting = PipelineSpec("p", ola="00:00:00-23:59:59")
    assert ingest.run_pipeline(spark, resting, specs, nothing).first()["job_status"] == FAILURE


def test_change_feed_over_two_loads(spark, frame, tmp_path):
    spec = PipelineSpec("p", target_path=str(tmp_path / "f"), landing_path=str(tmp_path / "l"), load_type="delta", primary_key=("id",), change_indicator="op")
    specs = [ColumnSpec(1, "i", "id", "int"), ColumnSpec(2, "v", "v", "string")]
    schema = "i string, v string, op string"
    loads = [
        [("1", "a", None), ("2", "b", "INS"), ("3", "c", "DEL"), ("4", "d", "UPD")],
        [("1", "A", "UPD"), ("2", "b", "DEL"), ("5", "e", "INS"), ("4", "x", None)],
    ]
    for load in loads:
        assert ingest.run_pipeline(spark, spec, specs, frame(load, schema)).first()["job_status"] == SUCCESS
    assert rows(read_target(spark, spec.target_path)) == [(1, "A"), (4, "d"), (5, "e")]


def test_partitioned_loads(spark, frame, tmp_path):
    spec = PipelineSpec("p", target_path=str(tmp_path / "f"), landing_path=str(tmp_path / "l"), load_type="delta", primary_key=("id",), partition_column="load_date")
    specs = [ColumnSpec(1, "i", "id", "int")]
    for day in ("2024-01-01", "2024-01-02"):
        ingest.run_pipeline(spark, spec, specs, frame([("1",)], "i string"), run_date=day)
    assert spark.read.parquet(spec.target_path).count() == 2


def test_a_database_target_is_merged_with(spark, frame, pipeline, monkeypatch, tmp_path):
    """A folder stands for the database; its reads and writes are those of the JDBC module."""
    spec, specs = pipeline
    spec, database = replace(spec, target_table="dbo.t"), jdbc.Database("sqlserver", "jdbc:sqlserver://h")
    place, asked = str(tmp_path / "table"), []

    def query(spark, database, text):
        asked.append(text)
        return frame([(len(list(tmp_path.glob("table"))),)], "n int")

    monkeypatch.setattr(jdbc, "read_query", query)
    monkeypatch.setattr(jdbc, "read_table", lambda spark, database, table: spark.read.parquet(place))
    monkeypatch.setattr(jdbc, "write_table", lambda df, database, table: df.write.mode("overwrite").parquet(place))
    schema = "i string, v string, changed timestamp_ntz"
    early, late = datetime(2024, 1, 1), datetime(2024, 2, 1)
    for rows_in, counts in (([("1", "a", early), ("2", "b", early)], 2), ([("2", "B", late), ("3", "c", late)], 3)):
        outcome = ingest.run_pipeline(spark, spec, specs, frame(rows_in, schema), database=database).first()
        assert (outcome["job_status"], outcome["final_count"]) == (SUCCESS, counts)
    assert rows(spark.read.parquet(place)) == [(1, "a"), (2, "B"), (3, "c")]
    assert asked[0] == "SELECT COUNT(*) AS n FROM information_schema.tables WHERE table_schema = 'dbo' AND table_name = 't'"
    with pytest.raises(ValueError):
        jdbc.exists_query(database, "t")


def test_by_day(spark, frame, pipeline):
    spec, specs = pipeline
    rows_in = [(str(i), f"v{i}", datetime(2024, 1, i, 12)) for i in (1, 2, 3)]
    source = frame(rows_in, "i string, v string, changed timestamp_ntz")
    outcomes = ingest.run_by_day(spark, spec, specs, source, "2024-01-01 13:00:00", "2024-01-03 23:00:00")
    found = outcomes.select("business_order_from_dttm", "landing_count", "final_count").collect()
    assert [tuple(r) for r in found] == [("2024-01-01 13:00:00", 0, 0), ("2024-01-02 00:00:00", 1, 1), ("2024-01-03 00:00:00", 1, 2)]
    assert rows(read_target(spark, spec.target_path)) == [(2, "v2"), (3, "v3")]


# --- lineage


def test_log_and_closure(spark, frame):
    a, b, c = (frame([(1, n)], f"k int, {n} string") for n in "abc")
    log = lineage.LineageLog(spark, "script", "esg")
    ab = log.apply(inner_join, "ab", {"a": a, "b": b}, "k", record={"key_cols": ["k"]})
    renamed = log.apply(rename, "r", {"ab": ab}, {"a": "z"})
    full = log.apply(outer_join, "out", {"r": renamed, "c": c}, "k")
    log.finish(full, "out", "FINAL_T", "/final/t")
    records = log.to_frame()
    assert records.count() == 4 and len(records.columns) == 21
    renaming = records.filter("transformation_func_nm = 'rename'").first()
    assert (renaming["added_col"], renaming["dropped_cols"]) == (["z"], ["a"])
    targets = frame([("FINAL_T",)], "target string")
    assert rows(lineage.root_sources(lineage.edges_of(records), targets)) == [("FINAL_T", "a"), ("FINAL_T", "b"), ("FINAL_T", "c")]
    feed = catalog.processed_feed(records)
    assert feed.columns == catalog.LABELS
    assert rows(feed.filter("`Asset Type` = 'Table'").select("Name", "Community", "File Location")) == [("final_t", "DataLake_ESG", "/final/t")]
    assert rows(feed.filter("`Asset Type` = 'Column'").select("Name", "Data Type")) == [("b", "Text"), ("c", "Text"), ("k", "Whole Number"), ("z", "Text")]
    assert lineage.forget_script(records, "script").count() == 0
    assert lineage.forget_script(records, "other").count() == 4


def test_closure_ends_on_cycles_and_diamonds(frame):
    edges = frame([("s", "x"), ("x", "y"), ("y", "x"), ("y", "t"), ("s", "t"), ("u", "v"), ("v", "w")], "source string, target string")
    targets = frame([("t",), ("w",), ("nowhere",)], "target string")
    assert rows(lineage.root_sources(edges, targets)) == [("t", "s"), ("w", "u")]


def test_closure_of_a_long_chain(frame):
    edges = frame([(str(i), str(i + 1)) for i in range(12)], "source string, target string")
    assert rows(lineage.root_sources(edges, frame([("12",)], "target string"))) == [("12", "0")]


def test_closure_takes_logarithmic_rounds(frame, monkeypatch):
    rounds = []
    monkeypatch.setattr(lineage, "cut", lambda df: rounds.append(1) or cut(df))
    edges = [(str(i), str(i + 1)) for i in range(1000)] + [("side", "500"), ("1000", "990")]  # with a circle at the end
    assert rows(lineage.root_sources(frame(edges, "source string, target string"), frame([("1000",), ("499",)], "target string"))) == [
        ("1000", "0"), ("1000", "side"), ("499", "0"),
    ]
    assert len(rounds) <= 13


# --- catalog


def test_raw_feed(frame):
    pipes = frame(
        [("p", "about p", "esg", "", "T", '[{"environment_name":"prd","target_bucket_name":"b"}]', "true", "published"), ("q", "", "oem", "", "U", "[]", "true", "draft")],
        "pipeline_id string, pipeline_desc string, domain_name string, target_file_name string, target_table_name string, target_environments string, active string, status string",
    )
    columns = frame(
        [("1", "p", "id", "BIGINT", None, None, None), ("2", "p", "id", "STRING", None, None, None), ("3", "q", "x", "int", None, None, None)],
        "column_id string, pipeline_id string, target_column_name string, target_datatype string, target_length string, target_precision string, target_datetime_format string",
    )
    classes = frame([("9", "SECRET", "d")], "column_id string, classification_level string, business_description string")
    feed = catalog.raw_feed(columns, classes, pipes, "PRD")
    assert feed.columns == catalog.LABELS
    assert [r["Asset Type"] for r in feed.collect()] == ["Table", "Column"]
    column = feed.filter("`Asset Type` = 'Column'").first()
    assert (column["Data Type"], column["Size"], column["Data Classification"], column["Full Name"]) == ("Whole Number", "0", "INTERNAL", "id > T")
    assert feed.first()["File Location"] == "s3://b/data/final/T"


def test_dataset_columns(frame):
    found = catalog.dataset_columns({"d": frame([(1, "a")], "x int, y string")}).first()
    assert json.loads(found["columns"]) == [{"column_name": "x", "column_type": "int"}, {"column_name": "y", "column_type": "string"}]


# --- bonds


def test_bonds(frame):
    table = frame(
        [("A", "SOVEREIGN", "19980601", 2.0, 5.0, 1.0, 10.0), ("A", "SOVEREIGN", "bad", 4.0, None, 3.0, 30.0), ("A", "CORPORATE", "19990601", 1.0, 9.0, 1.0, 60.0), ("B", "SOVEREIGN", "20200101", 1.0, 1.0, 1.0, 0.0)],
        "Country string, IssrClsL2 string, MaturDate string, Maturity double, YldMatE double, OAStoWrsE double, OutstandE double",
    )
    ready = bonds.prepared(table)
    assert rows(bonds.weighted_yield(ready, "Country")) == [("A", 1.25), ("B", None)]
    assert rows(bonds.weighted_spread(ready, "Country")) == [("A", 2.5), ("B", None)]
    assert rows(bonds.weighted_maturity(ready, "Country", issuer_class="")) == [("A", 2.0), ("B", None)]
    report = bonds.report(ready, "Country", "1998-01-01").filter("Country = 'A'").first()
    assert report["Total USD Debt Outstanding"] == 100.0
    assert report["Portion of Debt Maturing in 12 months"] == 0.1
    assert report["Debt Maturing Within 24 months"] == 70.0
    assert report["Weighted Yield of Debt Maturing within 24 Months"] == 5.0
    parts = bonds.maturing_debt(ready, "Country", "1998-01-01")
    assert rows(parts) == rows(bonds.report(ready, "Country", "1998-01-01").select(*parts.columns))


def test_bond_enrichment_reports_unmapped(frame):
    table = frame([("A", 1), ("Z", 2)], "Country string, v int")
    countries = frame([("A", "Aland")], "Country string, OrganizationName string")
    organisations = frame([("Aland", "Europe", "Aaa")], "OrganizationName string, Region string, FCSovereignRating string")
    found, unmapped = bonds.with_organisations(table, countries, organisations)
    assert rows(found.select("v", "Region", "Rating")) == [(1, "Europe", "Aaa"), (2, None, None)]
    assert rows(unmapped) == [("Country", "Z")]


def test_series_panel(frame):
    series = frame([("o1", "a", 1), ("o1", "c", 2), ("o3", "a", 3)], "org string, ind string, v int")
    panel, missing = bonds.series_panel(series, frame([("o1",), ("o2",)], "org string"), ["a", "b"], "ind")
    assert rows(panel) == [("o1", "a", 1)]
    assert rows(missing) == [("o1", "b"), ("o2", "a"), ("o2", "b")]


# --- methodology


def test_methodology_loads(frame):
    documents = frame(
        [
            ("b1", "Old", " New ", "T", "c1", "rr-x", "2024-01-02 03:04:05", "2024-01-03 00:00:00", "9", "dt", " Title ", "E", "Final ", "eng"),
            ("b1", None, "New", "T", "c2", "r", "bad", None, "10", "dt", "Title 2", "E", "Final", "eng"),
            ("b2", "Nobody", "Other", "T", "c3", None, None, None, "x", "dt", "T3", "E", "Unknown", "fra"),
        ],
        "batch string, merged_to_methodology_name string, methodology_name string, methodology_type_code string, methodology_document_cms_document_identifier string, methodology_document_rmc_document_identifier string, methodology_document_publication_datetime string, methodology_document_modification_datetime string, methodology_document_version_number string, methodology_document_type_code string, methodology_document_publication_name string, publishing_entity_code string, methodology_status string, language_name string",
    )
    types = frame([("TC", "T")], "meth_typ_cd string, meth_typ_desc string")
    existing = methodology.stamped(frame([(5, None, "Old", "TC")], "meth_id long, merg_to_meth_id long, meth_nm string, meth_typ_cd string"), "2023-01-01", "u")
    meth = methodology.load_methodologies(documents, types, existing, "2024-02-01 00:00:00", "u")
    assert rows(meth.select("meth_id", "meth_nm", "merg_to_meth_id")) == [(5, "Old", None), (6, "New", None)]
    again = methodology.load_methodologies(documents, types, meth, "2024-03-01 00:00:00", "u")
    assert rows(again.select("meth_id", "meth_nm")) == [(5, "Old"), (6, "New")]
    by_text = methodology.methodologies(documents, types, existing, text_versions=True)
    assert (5, "New", "TC") in rows(by_text)

    statuses = frame([("F", "Final")], "meth_doc_status_cd string, meth_doc_status_desc string")
    docs = methodology.load_methodology_documents(documents, meth, statuses, None, "2024-02-01 00:00:00", "u")
    found = rows(docs.select("meth_doc_id", "meth_id", "cms_doc_id", "rmc_doc_id", "publ_titl_text", "meth_vrsn_num"))
    assert found == [(1, 6, "c1", "rr", "Title", 9), (2, 6, "c2", "", "Title 2", 10)]

    consultations = frame(
        [("b1", " RFC ", "2024-01-01 10:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:00", "q1", "m", "open", "ROC", "k1", "n", "2024-05-01", "done")],
        "batch string, request_for_comment_publication_name string, request_for_comment_open_datetime string, request_for_comment_close_datetime string, request_for_comment_original_close_datetime string, request_for_comment_cms_document_identifier string, request_for_comment_rmc_document_identifier string, request_for_comment_status_code string, result_of_consultation_publication_name string, result_of_consultation_cms_document_identifier string, result_of_consultation_rmc_document_identifier string, result_of_consultation_publication_date string, result_of_consultation_status_code string",
    )
    rfc_status = frame([("O", "open")], "rfc_status_cd string, rfc_status_desc string")
    rfc = methodology.load_comment_requests(consultations, rfc_status, None, "2024-02-01 00:00:00", "u")
    assert rows(rfc.select("rfc_id", "rfc_publcn_name", F.col("rfc_open_dtm").cast("string"))) == [(1, "RFC", "2024-01-01")]
    unknown = methodology.comment_requests(consultations, rfc_status.filter("false"), keep_unknown_status=True)
    assert unknown.count() == 1 and methodology.comment_requests(consultations, rfc_status.filter("false")).count() == 0
    roc_status = frame([("D", "done")], "roc_status_cd string, roc_status_desc string")
    roc = methodology.load_consultation_results(consultations, rfc, roc_status, None, "2024-02-01 00:00:00", "u")
    assert rows(roc.select("rfc_id", "roc_cms_doc_id", "roc_status_cd")) == [(1, "k1", "D")]
    bridge = methodology.load_methodology_requests(consultations, documents, rfc, docs, None, "2024-02-01 00:00:00", "u")
    assert rows(bridge.select("rfc_id", "meth_doc_id")) == [(1, 1), (1, 2)]


def text_pipeline(tmp_path, lines, **settings):
    (tmp_path / "in.csv").write_text("id,stamp\n" + "\n".join(lines) + "\n")
    paths = {"source_path": str(tmp_path / "in.csv"), "target_path": str(tmp_path / "final"), "landing_path": str(tmp_path / "landing")}
    settings = {"load_type": "delta", "primary_key": ("id",), "cdc_timestamp_columns": ("stamp",)} | settings
    return pipelines.PipelineSpec("p", **paths, **settings)


STAMPED = [ColumnSpec(1, "id", "id", "int"), ColumnSpec(2, "stamp", "stamp", "timestamp", source_datetime_format="dd/MM/yyyy")]


def test_text_dates_are_parsed_before_the_window(spark, tmp_path):
    first = text_pipeline(tmp_path, [f"{d},{d:02d}/03/2024" for d in range(1, 29)] + ["99,", "98,not a date"])
    done = ingest.run_pipeline(spark, first, STAMPED, started=datetime(2024, 4, 1)).first()
    assert (done.job_status, done.landing_count, done.final_count) == (pipelines.SUCCESS, 30, 30)
    later = text_pipeline(tmp_path, ["1,02/04/2024", "1,03/04/2024", "2,01/03/2024", "40,01/05/2024"])
    done = ingest.run_pipeline(spark, later, STAMPED, since="2024-04-01", started=datetime(2024, 4, 10)).first()
    assert (done.job_status, done.landing_count, done.final_count) == (pipelines.SUCCESS, 2, 30)
    assert spark.read.parquet(str(tmp_path / "final")).filter("id = 1 and stamp = '2024-04-03'").count() == 1


def test_empty_increments_touch_nothing_and_full_loads_take_all(spark, tmp_path):
    spec = text_pipeline(tmp_path, ["1,01/03/2024", "2,02/03/2024"])
    ingest.run_pipeline(spark, spec, STAMPED, started=datetime(2024, 4, 1))
    done = ingest.run_pipeline(spark, spec, STAMPED, since="2024-04-01", started=datetime(2024, 4, 2)).first()
    assert (done.job_status, done.landing_count) == (pipelines.SUCCESS, 0)
    assert spark.read.parquet(str(tmp_path / "landing")).count() == 2
    full = text_pipeline(tmp_path, ["1,01/03/2024", "2,02/03/2024", "3,09/04/2024"], load_type="full")
    assert ingest.run_pipeline(spark, full, STAMPED, since="2024-04-01", started=datetime(2024, 4, 2)).first().final_count == 3


def test_a_repeated_day_replaces_its_partition(spark, tmp_path):
    spec = text_pipeline(tmp_path, ["1,01/03/2024", "2,02/03/2024"], partition_column="day", primary_key=())
    for _ in range(2):
        assert ingest.run_pipeline(spark, spec, STAMPED, started=datetime(2024, 4, 1)).first().job_status == pipelines.SUCCESS
    assert spark.read.parquet(str(tmp_path / "final")).count() == 2
    ingest.run_pipeline(spark, spec, STAMPED, started=datetime(2024, 4, 1, 12))  # a later increment of that day
    assert spark.read.parquet(str(tmp_path / "final")).count() == 4


def test_records_and_source_queries():
    from millrace.plans import runs

    spec = runs.spec_from_record({"pipeline_id": "p", "primary_key": "['a', 'b']", "cdc_timestamp_columns": "u,v", "sla": "null", "header": "True", "other": 1})
    assert (spec.primary_key, spec.cdc_timestamp_columns, spec.sla, spec.header) == (("a", "b"), ("u", "v"), "", True)
    specs = [ColumnSpec(10, "b", "b"), ColumnSpec(9, "a", "a")]
    assert runs.source_query("t", specs, ["u"]) == "select a, b from t"
    window = ("2024-01-01 00:00:00", "2024-01-02 00:00:00.123")
    assert runs.source_query("t", specs, ["u", "v"], *window) == (
        "select a, b from t where u between '2024-01-01 00:00:00' and '2024-01-02 00:00:00' or v between '2024-01-01 00:00:00' and '2024-01-02 00:00:00'"
    )
    assert "u between to_timestamp('2024-01-01 00:00:00','yyyy-MM-dd hh24:mi:ss')" in runs.source_query("t", specs, ["u"], *window, dialect="oracle")
    template = "select * from t where x ~ 'a{2}' and u between '{}' and '{}'"
    assert runs.source_query("t", specs, (), "1", "2", template=template) == "select * from t where x ~ 'a{2}' and u between '1' and '2'"
    assert runs.source_query("t", specs, (), None, "2", template=template) == "select a, b from t"


def test_a_source_that_cannot_be_read_leaves_the_others_alone(spark, frame, tmp_path):
    from millrace.plans import runs

    (tmp_path / "in.csv").write_text("id,name\n1,a\n2,b\n")
    place = str(tmp_path)
    inventory = frame(
        [("bad", "1", "", f"{place}/none.csv", f"{place}/l1", f"{place}/f1"), ("good", "1", "", f"{place}/in.csv", f"{place}/l2", f"{place}/f2")],
        "pipeline_id string, version_number string, active string, source_path string, landing_path string, target_path string",
    )
    columns = frame(
        [(p, "1", str(k), c, c, "string") for p in ("bad", "good") for k, c in ((1, "id"), (2, "name"))],
        "pipeline_id string, version_number string, sequence_number string, source_column_name string, target_column_name string, target_datatype string",
    )
    found = {r.pipeline_id: r for r in runs.run_pipelines(spark, inventory, columns).collect()}
    assert found["good"].job_status == SUCCESS and found["good"].final_count == 2 and found["bad"].job_status == FAILURE
