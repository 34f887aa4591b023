"""The methodology warehouse. `orders` plays the document staging table, `lineitem` the consultations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.joins import bridge, left_join_different_key_names
from millrace.operators.windows import surrogate_keys
from millrace.plans import methodology
from millrace.queries import Tables, register

LOADED = "2024-02-01 00:00:00"
USER = "loader"


def texts(**columns):
    return [c.cast("string").alias(n) for n, c in columns.items()]


def documents(t: Tables):
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.orders.select(
        *texts(
            batch=F.col("o_orderkey"),
            merged_to_methodology_name=F.col("o_orderstatus"),
            methodology_name=F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")),
            methodology_type_code=F.col("o_orderstatus"),
            methodology_document_cms_document_identifier=F.col("o_orderkey"),
            methodology_document_rmc_document_identifier=F.concat(F.col("o_custkey").cast("string"), F.lit("-x")),
            methodology_document_publication_datetime=day,
            methodology_document_modification_datetime=day,
            methodology_document_version_number=F.month("o_orderdate"),
            methodology_document_type_code=F.col("o_orderstatus"),
            methodology_document_publication_name=F.concat(F.lit(" title "), F.col("o_orderkey").cast("string")),
            publishing_entity_code=F.col("o_custkey"),
            methodology_status=F.concat("o_orderstatus", F.lit(" ")),
            language_name=F.substring("o_orderpriority", 1, 1),
        )
    )


def consultations(t: Tables):
    day = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return t.lineitem.select(
        *texts(
            batch=F.col("l_orderkey"),
            request_for_comment_publication_name=F.concat("l_returnflag", F.lit(" ")),
            request_for_comment_open_datetime=day,
            request_for_comment_close_datetime=day,
            request_for_comment_original_close_datetime=day,
            request_for_comment_cms_document_identifier=F.concat_ws("-", "l_orderkey", "l_linenumber"),
            request_for_comment_rmc_document_identifier=F.col("l_partkey"),
            request_for_comment_status_code=F.col("l_linestatus"),
            result_of_consultation_publication_name=F.col("l_returnflag"),
            result_of_consultation_cms_document_identifier=F.col("l_suppkey"),
            result_of_consultation_rmc_document_identifier=F.col("l_partkey"),
            result_of_consultation_publication_date=day,
            result_of_consultation_status_code=F.col("l_linestatus"),
        )
    )


def lookup(df, column: str, prefix: str):
    """A code table made of the distinct values of a column."""
    values = df.select(F.col(column).alias("v")).distinct()
    return values.select(F.concat(F.lit("C-"), "v").alias(f"{prefix}_cd"), F.col("v").alias(f"{prefix}_desc"))


def existing_methodologies(t: Tables):
    names = t.orders.select(F.col("o_orderstatus").alias("meth_nm")).distinct()
    keyed = surrogate_keys(names, "meth_nm", "meth_id")
    rows = keyed.select(
        "meth_id", F.lit(None).cast("long").alias("merg_to_meth_id"), "meth_nm", F.lit("C-F").alias("meth_typ_cd")
    )
    return methodology.stamped(rows, "2024-01-01 00:00:00", "before")


OLD_SQL = "old AS (SELECT o_orderstatus AS meth_nm, row_number() OVER (ORDER BY o_orderstatus) AS meth_id FROM (SELECT DISTINCT o_orderstatus FROM orders))"


@register(
    f"WITH {OLD_SQL}, latest AS (SELECT DISTINCT o_orderpriority AS nm, o_orderstatus AS st FROM orders a WHERE month(o_orderdate) = "
    "(SELECT max(month(o_orderdate)) FROM orders b WHERE b.o_orderpriority = a.o_orderpriority)), "
    "one AS (SELECT nm, meth_id AS parent, 'C-' || st AS typ, row_number() OVER (PARTITION BY nm ORDER BY meth_id DESC, st DESC) rn "
    "FROM latest JOIN old ON st = meth_nm) "
    "SELECT meth_id, CAST(NULL AS BIGINT) AS merg_to_meth_id, meth_nm, 'C-F' AS meth_typ_cd, TIMESTAMP '2024-01-01' AS modified_dtm, "
    "'before' AS modified_user_id FROM old UNION ALL SELECT (SELECT max(meth_id) FROM old) + row_number() OVER (ORDER BY nm), parent, nm, typ, "
    "TIMESTAMP '2024-02-01', 'loader' FROM one WHERE rn = 1"
)
def methodology_load(t: Tables):
    docs = documents(t)
    types = lookup(t.orders, "o_orderstatus", "meth_typ")
    return methodology.load_methodologies(docs, types, existing_methodologies(t), LOADED, USER)


def methodology_table(t: Tables):
    names = t.orders.select(F.col("o_orderpriority").alias("meth_nm")).distinct()
    return surrogate_keys(names, "meth_nm", "meth_id")


METH_SQL = "meth AS (SELECT p, row_number() OVER (ORDER BY p) AS meth_id FROM (SELECT DISTINCT o_orderpriority AS p FROM orders))"
METH_DOC_SQL = (
    "meth_doc AS (SELECT row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS meth_doc_id, meth_id, CAST(o_custkey AS VARCHAR) AS publ_entity_cd, "
    "left(o_orderpriority, 1) AS lang_iso_alpha_3_cd, CAST(month(o_orderdate) AS INTEGER) AS meth_vrsn_num, o_orderstatus AS meth_doc_typ_cd, "
    "'title ' || o_orderkey AS publ_titl_text, CAST(o_orderkey AS VARCHAR) AS cms_doc_id, CAST(o_custkey AS VARCHAR) AS rmc_doc_id, "
    "o_orderdate AS publcn_dtm, CAST(o_orderdate AS DATE) AS meth_doc_modified_dtm, 'C-' || o_orderstatus AS status_cd, "
    "TIMESTAMP '2024-02-01' AS modified_dtm, 'loader' AS modified_user_id FROM orders JOIN meth ON o_orderpriority = p)"
)


def methodology_document_table(t: Tables):
    statuses = lookup(t.orders, "o_orderstatus", "meth_doc_status")
    return methodology.load_methodology_documents(documents(t), methodology_table(t), statuses, None, LOADED, USER)


@register(f"WITH {METH_SQL}, {METH_DOC_SQL} SELECT * FROM meth_doc")
def methodology_document_load(t: Tables):
    return methodology_document_table(t)


RFC_SQL = (
    "rfc AS (SELECT l_returnflag AS rfc_publcn_name, CAST(l_shipdate AS DATE) AS rfc_open_dtm, CAST(l_shipdate AS DATE) AS rfc_close_dtm, "
    "CAST(l_shipdate AS DATE) AS rfc_origin_close_dtm, l_orderkey || '-' || l_linenumber AS rfc_cms_doc_id, CAST(l_partkey AS VARCHAR) AS rfc_rmc_doc_id, "
    "'C-' || l_linestatus AS rfc_status_cd FROM lineitem)"
)


def requests(t: Tables):
    return methodology.comment_requests(consultations(t), lookup(t.lineitem, "l_linestatus", "rfc_status"))


@register(f"WITH {RFC_SQL} SELECT * FROM rfc")
def comment_request_rows(t: Tables):
    return requests(t)


@register(
    f"WITH {RFC_SQL} SELECT row_number() OVER (ORDER BY rfc_cms_doc_id) AS rfc_id, rfc_cms_doc_id, max(rfc_open_dtm) AS rfc_open_dtm FROM rfc GROUP BY rfc_cms_doc_id"
)
def comment_request_load(t: Tables):
    statuses = lookup(t.lineitem, "l_linestatus", "rfc_status")
    loaded = methodology.load_comment_requests(consultations(t), statuses, None, LOADED, USER)
    return loaded.select("rfc_id", "rfc_cms_doc_id", "rfc_open_dtm")


def numbered_requests(t: Tables):
    """Requests with an id made of the order and line, so that both sides of a check can tell it."""
    parts = F.split("rfc_cms_doc_id", "-")
    return requests(t).withColumn("rfc_id", parts[0].cast("long") * 100 + parts[1].cast("long"))


@register(
    "WITH a AS (SELECT l_orderkey * 100 + l_linenumber AS rfc_id, * FROM lineitem) SELECT a.rfc_id, a.l_returnflag AS roc_publcn_nm, "
    "CAST(a.l_suppkey AS VARCHAR) AS roc_cms_doc_id, CAST(a.l_partkey AS VARCHAR) AS roc_rmc_doc_id, CAST(a.l_shipdate AS DATE) AS roc_publcn_dtm, "
    "'C-' || a.l_linestatus AS roc_status_cd FROM a JOIN a b ON a.rfc_id = b.rfc_id AND a.l_returnflag = b.l_returnflag AND a.l_shipdate = b.l_shipdate"
)
def consultation_result_rows(t: Tables):
    statuses = lookup(t.lineitem, "l_linestatus", "roc_status")
    return methodology.consultation_results(consultations(t), numbered_requests(t), statuses)


@register(
    f"WITH {METH_SQL}, {METH_DOC_SQL} SELECT DISTINCT l_orderkey * 100 + l_linenumber AS rfc_id, m.meth_doc_id FROM lineitem "
    "JOIN orders o ON l_orderkey = o_orderkey JOIN meth_doc m ON m.publ_entity_cd = CAST(o_custkey AS VARCHAR) AND m.meth_vrsn_num = month(o_orderdate) "
    "AND m.meth_doc_typ_cd = o_orderstatus AND m.lang_iso_alpha_3_cd = left(o_orderpriority, 1)"
)
def methodology_request_bridge(t: Tables):
    return methodology.methodology_requests(
        consultations(t), documents(t), numbered_requests(t), methodology_document_table(t)
    )


@register(
    "SELECT DISTINCT l_orderkey, c_custkey, s_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey"
)
def bridge_load(t: Tables):
    """Orders that link a customer and a supplier of one nation."""
    sold = t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"))
    links = left_join_different_key_names(sold, t.orders.select("o_orderkey", "o_custkey"), ["l_orderkey"], ["o_orderkey"])
    nations = ("nation", F.col("c_nationkey")), ("nation", F.col("s_nationkey"))
    return bridge(
        links.withColumnRenamed("o_custkey", "c_custkey"), t.customer.withColumn(*nations[0]), t.supplier.withColumn(*nations[1]),
        "c_custkey", "s_suppkey", agree=["nation"], keep=["l_orderkey"],
    )


LATER = "2024-03-01 00:00:00"
SPLIT = "1996-01-01"


@register(
    f"WITH {METH_SQL}, {METH_DOC_SQL}, two AS (SELECT *, publcn_dtm < DATE '{SPLIT}' AS old FROM meth_doc) "
    "SELECT CASE WHEN old THEN 0 ELSE (SELECT count(*) FROM two WHERE old) END + row_number() OVER (PARTITION BY old ORDER BY cms_doc_id) "
    "AS meth_doc_id, meth_id, publ_entity_cd, lang_iso_alpha_3_cd, meth_vrsn_num, meth_doc_typ_cd, publ_titl_text, cms_doc_id, rmc_doc_id, "
    "publcn_dtm, meth_doc_modified_dtm, status_cd, TIMESTAMP '2024-03-01' AS modified_dtm, 'later' AS modified_user_id FROM two"
)
def methodology_document_reload(t: Tables):
    """Documents before a date are known already: they keep their ids, later ones get the next."""
    statuses = lookup(t.orders, "o_orderstatus", "meth_doc_status")
    known = documents(t).filter(F.col("methodology_document_publication_datetime") < SPLIT)
    first = methodology.load_methodology_documents(known, methodology_table(t), statuses, None, LOADED, USER)
    return methodology.load_methodology_documents(documents(t), methodology_table(t), statuses, first, LATER, "later")


@register(
    f"WITH {RFC_SQL}, one AS (SELECT rfc_cms_doc_id, max(rfc_open_dtm) AS d, min(rfc_open_dtm) < DATE '{SPLIT}' AS old FROM rfc GROUP BY 1) "
    "SELECT CASE WHEN old THEN 0 ELSE (SELECT count(*) FROM one WHERE old) END + row_number() OVER (PARTITION BY old ORDER BY rfc_cms_doc_id) "
    "AS rfc_id, rfc_cms_doc_id, d AS rfc_open_dtm, d AS rfc_close_dtm, d AS rfc_origin_close_dtm, TIMESTAMP '2024-03-01' AS modified_dtm, "
    "'later' AS modified_user_id FROM one"
)
def comment_request_reload(t: Tables):
    statuses = lookup(t.lineitem, "l_linestatus", "rfc_status")
    known = consultations(t).filter(F.col("request_for_comment_open_datetime") < SPLIT)
    first = methodology.load_comment_requests(known, statuses, None, LOADED, USER)
    loaded = methodology.load_comment_requests(consultations(t), statuses, first, LATER, "later")
    # of equally new versions of a request either may stay; they differ in the other columns only
    return loaded.drop("rfc_publcn_name", "rfc_rmc_doc_id", "rfc_status_cd")


@register(
    f"SELECT rfc_id, d AS roc_publcn_dtm, CASE WHEN d < DATE '{SPLIT}' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-03-01' END AS modified_dtm, "
    f"CASE WHEN d < DATE '{SPLIT}' THEN 'loader' ELSE 'later' END AS modified_user_id FROM (SELECT l_orderkey * 100 + l_linenumber AS rfc_id, "
    "CAST(max(l_shipdate) AS DATE) AS d FROM lineitem GROUP BY 1)"
)
def consultation_result_load(t: Tables):
    """Two loads, of results before and after a date: untouched rows keep their stamps."""
    statuses = lookup(t.lineitem, "l_linestatus", "roc_status")
    early = F.col("result_of_consultation_publication_date") < SPLIT
    first = methodology.load_consultation_results(consultations(t).filter(early), numbered_requests(t), statuses, None, LOADED, USER)
    loaded = methodology.load_consultation_results(consultations(t).filter(~early), numbered_requests(t), statuses, first, LATER, "later")
    return loaded.select("rfc_id", "roc_publcn_dtm", "modified_dtm", "modified_user_id")


@register(
    f"WITH {METH_SQL}, {METH_DOC_SQL} SELECT rfc_id, meth_doc_id, CASE WHEN late THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-02-01' END "
    "AS modified_dtm, CASE WHEN late THEN 'later' ELSE 'loader' END AS modified_user_id FROM (SELECT l_orderkey * 100 + l_linenumber "
    f"AS rfc_id, m.meth_doc_id, bool_or(l_shipdate >= DATE '{SPLIT}') AS late FROM lineitem JOIN orders o ON l_orderkey = o_orderkey JOIN meth_doc m "
    "ON m.publ_entity_cd = CAST(o_custkey AS VARCHAR) AND m.meth_vrsn_num = month(o_orderdate) AND m.meth_doc_typ_cd = o_orderstatus "
    "AND m.lang_iso_alpha_3_cd = left(o_orderpriority, 1) GROUP BY 1, 2)"
)
def methodology_request_load(t: Tables):
    early = F.col("request_for_comment_open_datetime") < SPLIT
    meth_docs = methodology_document_table(t)
    first = methodology.load_methodology_requests(
        consultations(t).filter(early), documents(t), numbered_requests(t), meth_docs, None, LOADED, USER
    )
    return methodology.load_methodology_requests(
        consultations(t).filter(~early), documents(t), numbered_requests(t), meth_docs, first, LATER, "later"
    )
