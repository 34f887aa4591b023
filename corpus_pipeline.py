"""A training corpus in five stages: quality, near-duplicates, repeated passages, mixture, packed sequences.

Each stage takes (spark, documents, folder of the tables) and returns a DataFrame; `run` writes each one's result as Parquet
to the shared folder and reads it back for the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import classifier, mixing, near, packing, suffixes
from millrace.llm.graph import fresh_name
from millrace.llm.queries import BYTE_TOKENIZER, END_ID, LANGUAGES, table, tokenizer_path
from millrace.session import cut

MIN_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labels, does not reject. Null texts count as empty ones, repeated rows are
    judged alike, an empty table stays empty; columns pass by, whatever their names."""
    forest = classifier.train(docs, table(spark, sf_dir, "labels"))
    name = fresh_name(docs.columns, "__score")
    return classifier.score(docs, forest, keep=name).where(F.col(name) >= MIN_QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8 and more. Of rows that share an id and words, one stays;
    texts without words stay once for each id, rows without an id all stay. An empty table stays empty; columns pass by,
    whatever their names."""
    found = near.judged(docs, near.Settings(size=5)).where(F.col("kept") & F.col("doc_id").isNotNull())
    copy = fresh_name(docs.columns, "__copy")
    kept = found.groupBy("doc_id", F.coalesce("print", "copy").alias("words")).agg(F.min("copy").alias(copy)).drop("words")
    nameless = docs.where(F.col("doc_id").isNull())
    keyed = docs.withColumn(copy, near.copy_of("text")).join(kept, ["doc_id", copy], "left_semi")
    return keyed.dropDuplicates(["doc_id", copy]).select(*docs.columns).unionByName(nameless)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that start elsewhere, too; n_chars follows. No row goes; null texts stay null and have no
    n_chars; an empty table stays empty."""
    cleaned = suffixes.remove_repeated(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say; no language is thinned to reach its weight. Null and empty texts have no tokens and
    stay once; repeated rows count one by one; an empty table stays empty."""
    labelled = docs.select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    model = mixing.train(docs, labelled, "lang", list(LANGUAGES))
    return mixing.repeated(mixing.mix(docs, model, LANGUAGES), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens. Null and empty texts are one end id; repeated rows are packed one by
    one; an empty table gives no pieces."""
    return packing.pack_tokens(docs, tokenizer_path("byte_bpe_50k.json"), end_id=END_ID, **BYTE_TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("packing", packed),
]

#: Trained models, signatures and tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return cut(STAGES[-1][1](spark, docs, sf_dir))
