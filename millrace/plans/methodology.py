"""The five loads of the methodology warehouse, from staging tables of texts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import drop_last
from millrace.operators.cdc import newest_per_key, upsert
from millrace.operators.project import quoted
from millrace.operators.windows import latest_rows, surrogate_keys
from millrace.session import cut


def stamped(df: DataFrame, modified_at: datetime | str, user: str | None) -> DataFrame:
    """Add when and by whom; without a user, Spark's current user."""
    who = F.current_user() if user is None else F.lit(user)
    return df.withColumns(
        {"modified_dtm": F.lit(str(modified_at)).cast("timestamp_ntz"), "modified_user_id": who}
    )


def moment(name: str) -> Column:
    return quoted(name).try_cast("timestamp_ntz")


def day(name: str) -> Column:
    return moment(name).cast("date")


def code_table(codes: DataFrame, *columns: str) -> DataFrame:
    """Columns of a lookup, written once, so that Spark knows its size and sends a small one to the rows. A join that moves the rows
    by a handful of codes would gather them in as many tasks."""
    return cut(codes.select(*columns))


def keyed(existing: DataFrame | None, incoming: DataFrame, natural_key: Sequence[str], id_name: str) -> DataFrame:
    """Incoming rows with their ids: known natural keys keep theirs, new ones get the next free numbers."""
    names, columns = list(natural_key), [id_name, *incoming.columns]
    if existing is None:
        return surrogate_keys(incoming, names, id_name)
    # Known and new rows come from the same join; it is written once and read for both.
    matched = cut(incoming.join(existing.select(*names, id_name), names, "left").select(*columns))
    new = surrogate_keys(matched.filter(quoted(id_name).isNull()).drop(id_name), names, id_name, existing)
    return matched.filter(quoted(id_name).isNotNull()).unionByName(new.select(*columns))


def load(existing: DataFrame | None, incoming: DataFrame, natural_key: Sequence[str], id_name: str) -> DataFrame:
    """The warehouse table after the load: an upsert by natural key."""
    return upsert(existing, keyed(existing, incoming, natural_key, id_name), list(natural_key))


def upsert_found(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An upsert of rows that are costly to find: it reads them for their keys and for themselves, so they are written once."""
    return upsert(existing, incoming if existing is None else cut(incoming), keys)


def methodologies(
    documents: DataFrame, types: DataFrame, existing: DataFrame | None, text_versions: bool = False
) -> DataFrame:
    """`meth` rows without ids: each name once, from its latest version.

    Versions are compared as numbers; `text_versions` compares them as texts, where '9' is after '10'.
    """
    name = F.trim("methodology_name")
    version = F.col("methodology_document_version_number")
    latest = latest_rows(documents, name, version if text_versions else version.try_cast("int"))
    codes = code_table(types, "meth_typ_cd", "meth_typ_desc")
    typed = latest.join(codes, F.col("methodology_type_code") == F.col("meth_typ_desc"))
    if existing is None:
        with_parent = typed.withColumn("merg_to_meth_id", F.lit(None).cast("long"))
    else:
        parents = existing.select(F.col("meth_id").alias("merg_to_meth_id"), F.col("meth_nm").alias("__parent"))
        with_parent = typed.join(parents, typed["merged_to_methodology_name"] == parents["__parent"], "left")
    return with_parent.select("merg_to_meth_id", name.alias("meth_nm"), "meth_typ_cd").distinct()


def methodology_documents(documents: DataFrame, meth: DataFrame, statuses: DataFrame) -> DataFrame:
    """`meth_doc` rows without ids. The last two characters of the rmc identifier are left out."""
    named = documents.join(code_table(meth, "meth_id", "meth_nm"), F.trim("methodology_name") == F.col("meth_nm"))
    known = named.join(
        code_table(statuses, "meth_doc_status_cd", "meth_doc_status_desc"),
        F.trim("methodology_status") == F.col("meth_doc_status_desc"),
    )
    return known.select(
        "meth_id",
        F.col("publishing_entity_code").alias("publ_entity_cd"),
        F.col("language_name").alias("lang_iso_alpha_3_cd"),
        F.col("methodology_document_version_number").try_cast("int").alias("meth_vrsn_num"),
        F.col("methodology_document_type_code").alias("meth_doc_typ_cd"),
        F.trim("methodology_document_publication_name").alias("publ_titl_text"),
        F.col("methodology_document_cms_document_identifier").alias("cms_doc_id"),
        drop_last("methodology_document_rmc_document_identifier", 2).alias("rmc_doc_id"),
        moment("methodology_document_publication_datetime").alias("publcn_dtm"),
        day("methodology_document_modification_datetime").alias("meth_doc_modified_dtm"),
        F.col("meth_doc_status_cd").alias("status_cd"),
    )


def comment_requests(consultations: DataFrame, statuses: DataFrame, keep_unknown_status: bool = False) -> DataFrame:
    """`rfc_doc` rows without ids. A status that is not in the lookup drops the row, or stays NULL if wished."""
    status = code_table(statuses, "rfc_status_cd", "rfc_status_desc")
    joined = consultations.join(
        status,
        F.col("request_for_comment_status_code") == F.col("rfc_status_desc"),
        "left" if keep_unknown_status else "inner",
    )
    return joined.select(
        F.trim("request_for_comment_publication_name").alias("rfc_publcn_name"),
        day("request_for_comment_open_datetime").alias("rfc_open_dtm"),
        day("request_for_comment_close_datetime").alias("rfc_close_dtm"),
        day("request_for_comment_original_close_datetime").alias("rfc_origin_close_dtm"),
        F.col("request_for_comment_cms_document_identifier").alias("rfc_cms_doc_id"),
        F.col("request_for_comment_rmc_document_identifier").alias("rfc_rmc_doc_id"),
        "rfc_status_cd",
    )


def consultation_results(consultations: DataFrame, requests: DataFrame, statuses: DataFrame) -> DataFrame:
    """`roc_doc` rows: the result of the request with the same identifier, name and dates."""
    a, b = consultations.alias("a"), requests.alias("b")
    same = (
        (F.col("a.request_for_comment_cms_document_identifier") == F.col("b.rfc_cms_doc_id"))
        & (F.trim("a.request_for_comment_publication_name") == F.col("b.rfc_publcn_name"))
        & (day("request_for_comment_open_datetime") == F.col("b.rfc_open_dtm").cast("date"))
        & (day("request_for_comment_close_datetime") == F.col("b.rfc_close_dtm").cast("date"))
        & (day("request_for_comment_original_close_datetime") == F.col("b.rfc_origin_close_dtm").cast("date"))
    )
    joined = a.join(b, same).join(
        code_table(statuses, "roc_status_cd", "roc_status_desc"),
        F.col("result_of_consultation_status_code") == F.col("roc_status_desc"),
    )
    return joined.select(
        "rfc_id",
        F.col("result_of_consultation_publication_name").alias("roc_publcn_nm"),
        F.col("result_of_consultation_cms_document_identifier").alias("roc_cms_doc_id"),
        F.col("result_of_consultation_rmc_document_identifier").alias("roc_rmc_doc_id"),
        day("result_of_consultation_publication_date").alias("roc_publcn_dtm"),
        "roc_status_cd",
    )


def methodology_requests(
    consultations: DataFrame, documents: DataFrame, requests: DataFrame, methodology_docs: DataFrame
) -> DataFrame:
    """`meth_rfc` rows: requests and documents of one batch.

    Both sides are reduced to their distinct (batch, id) before they meet, so that copies in a large batch do not
    multiply.
    """
    left = consultations.join(
        requests.select("rfc_id", "rfc_cms_doc_id"),
        F.col("request_for_comment_cms_document_identifier") == F.col("rfc_cms_doc_id"),
    )
    versions = documents.select(
        "batch",
        F.col("language_name").alias("lang_iso_alpha_3_cd"),
        F.col("methodology_document_version_number").try_cast("int").alias("meth_vrsn_num"),
        F.col("methodology_document_type_code").alias("meth_doc_typ_cd"),
        F.col("publishing_entity_code").alias("publ_entity_cd"),
    ).distinct()
    keys = ["lang_iso_alpha_3_cd", "meth_vrsn_num", "meth_doc_typ_cd", "publ_entity_cd"]
    right = versions.join(methodology_docs.select("meth_doc_id", *keys), keys)
    pairs = left.select("batch", "rfc_id").distinct().join(right.select("batch", "meth_doc_id").distinct(), "batch")
    return pairs.select("rfc_id", "meth_doc_id").distinct()


def load_methodologies(
    documents: DataFrame, types: DataFrame, existing: DataFrame | None, modified_at: datetime | str, user: str | None = None
) -> DataFrame:
    """`meth` after the load. Names repeated in one load keep the row with the highest parent id, then type."""
    rows = newest_per_key(methodologies(documents, types, existing), ["meth_nm"], ["merg_to_meth_id", "meth_typ_cd"])
    return load(existing, stamped(rows, modified_at, user), ["meth_nm"], "meth_id")


def load_methodology_documents(
    documents: DataFrame,
    meth: DataFrame,
    statuses: DataFrame,
    existing: DataFrame | None,
    modified_at: datetime | str,
    user: str | None = None,
) -> DataFrame:
    rows = newest_per_key(methodology_documents(documents, meth, statuses), ["cms_doc_id"], ["publcn_dtm", "meth_id"])
    return load(existing, stamped(rows, modified_at, user), ["cms_doc_id"], "meth_doc_id")


def load_comment_requests(
    consultations: DataFrame,
    statuses: DataFrame,
    existing: DataFrame | None,
    modified_at: datetime | str,
    user: str | None = None,
) -> DataFrame:
    rows = newest_per_key(comment_requests(consultations, statuses), ["rfc_cms_doc_id"], ["rfc_open_dtm", "rfc_close_dtm"])
    return load(existing, stamped(rows, modified_at, user), ["rfc_cms_doc_id"], "rfc_id")


def load_consultation_results(
    consultations: DataFrame,
    requests: DataFrame,
    statuses: DataFrame,
    existing: DataFrame | None,
    modified_at: datetime | str,
    user: str | None = None,
) -> DataFrame:
    rows = newest_per_key(consultation_results(consultations, requests, statuses), ["rfc_id"], ["roc_publcn_dtm"])
    return upsert_found(existing, stamped(rows, modified_at, user), ["rfc_id"])


def load_methodology_requests(
    consultations: DataFrame,
    documents: DataFrame,
    requests: DataFrame,
    methodology_docs: DataFrame,
    existing: DataFrame | None,
    modified_at: datetime | str,
    user: str | None = None,
) -> DataFrame:
    rows = methodology_requests(consultations, documents, requests, methodology_docs)
    return upsert_found(existing, stamped(rows, modified_at, user), ["rfc_id", "meth_doc_id"])
