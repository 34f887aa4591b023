"""File scans: Parquet, delimited, headerless, XML, JSON, and the dispatch between them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.conform import ColumnSpec, source_names
from millrace.sinks.commits import children, file_system, settle
from millrace.sources.dialect import Dialect, detect_dialect, detect_header_and_delimiter, file_name, split_start  # noqa: F401
from millrace.sources.xmltags import row_tags

def read_delimited(spark: SparkSession, path: str, delimiter: str = ",", escape: str = "\\") -> DataFrame:
    """Delimited text with a header; every column is a string. Files whose headers differ are an error."""
    return spark.read.csv(path, sep=delimiter, header=True, inferSchema=False, enforceSchema=False, escape=escape)


def read_headerless(
    spark: SparkSession, path: str | list[str], names: Sequence[str], delimiter: str = ",", escape: str = "\\", header: bool = False
) -> DataFrame:
    """Delimited text without a header, or with a known one to be skipped; every column is a string.

    The schema is given, so no pass over the data is spent on finding it.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, schema=schema, sep=delimiter, header=header, escape=escape)


def read_dialect(spark: SparkSession, path: str, names: Sequence[str], dialect: Dialect) -> DataFrame:
    """The declared columns of files as `detect_dialect` found them: by name where files have a header, each file's own order
    and further columns of its own allowed, else by place."""
    if not dialect.header:
        return read_headerless(spark, path, names, dialect.delimiter, dialect.escape)
    parts = []
    for columns, files in dialect.layouts:
        places = {c.strip().lower(): k for k, c in enumerate(columns)}
        numbered = [f"_{k}" for k in range(len(columns))]  # names in a file may come twice
        rows = read_headerless(spark, list(files) if files else path, numbered, dialect.delimiter, dialect.escape, header=True)
        parts.append(rows.select(*[F.col(f"_{places[n.strip().lower()]}").alias(n) for n in names]))
    return reduce(DataFrame.unionByName, parts)


def detect_row_tag(spark: SparkSession, path: str) -> str:
    """The one tag below the root elements of all files; several are an error. Declare the tag to save this pass."""
    tags = sorted(r.tag for r in row_tags(spark, path).limit(10).collect())  # enough to name in the error
    if len(tags) != 1:
        raise ValueError(f"one row tag expected below the root, found {tags or 'none'}")
    return tags[0]


def read_xml(
    spark: SparkSession, path: str, row_tag: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """XML records. Give a schema where it is known: inferring one reads the data twice."""
    reader = spark.read.format("xml").option("rowTag", row_tag or detect_row_tag(spark, path))
    return (reader if schema is None else reader.schema(schema)).load(path)


def json_shapes(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files that hold one array, files of one record a line): a file is an array if its first line that is not blank begins
    with a bracket. One scan; numbers of lines are all that is aggregated."""
    line = F.monotonically_increasing_id()  # grows within a file, and splits of a file are told apart by where they begin
    texts = spark.read.text(path).select(F.ltrim("value").alias("value"), F.col("_metadata.file_path").alias("file"), split_start(), line.alias("line"))
    first = texts.filter("value <> ''").groupBy("file", "start").agg(
        F.min("line").alias("first"), F.min(F.when(F.col("value").startswith("["), F.col("line"))).alias("bracket")
    )
    by_file = first.groupBy("file").agg(F.min(F.struct("start", (F.coalesce(F.col("bracket") == F.col("first"), F.lit(False))).alias("array"))).alias("head"))
    found = by_file.select(file_name().alias("file"), "head.array").toLocalIterator()
    arrays, lines = [], []
    for r in found:
        (arrays if r["array"] else lines).append(r["file"])
    return sorted(arrays), sorted(lines)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, array_file: bool | None = None
) -> DataFrame:
    """JSON records, one per line, or one array per file. A file that is one array cannot be split over tasks.

    Unless declared, the shape is looked up for each file, and files of both shapes are read as what they are; without a
    schema, columns that only one of the shapes has are null in the other's rows.
    """
    if array_file is not None:
        return spark.read.json(path, schema=schema, multiLine=array_file)
    arrays, lines = json_shapes(spark, path)
    if not arrays or not lines:
        return spark.read.json(path, schema=schema, multiLine=bool(arrays))
    parts = [spark.read.json(files, schema=schema, multiLine=multi) for files, multi in ((arrays, True), (lines, False))]
    return parts[0].unionByName(parts[1], allowMissingColumns=schema is None)


def extension_of(path: str) -> str:
    """The extension of the last part of a path, in lower case; '' when it has none."""
    suffix = PurePosixPath(path.rstrip("/")).suffix
    return suffix[1:].lower() if suffix and not suffix.endswith("*") else ""


def read_source(
    spark: SparkSession,
    path: str,
    specs: Iterable[ColumnSpec] = (),
    schema: T.StructType | str | None = None,
    header: bool | None = None,
    delimiter: str | None = None,
    row_tag: str | None = None,
    array_file: bool | None = None,
) -> DataFrame:
    """Read files by their extension; no extension means Parquet.

    `header`, `delimiter`, `row_tag` and `array_file` are settings of the source; what is not declared is looked up in all
    files, by names from the specs, and ambiguity is an error.
    """
    kind = extension_of(path)
    if kind in ("", "parquet"):
        return spark.read.parquet(path)
    if kind in ("csv", "txt", "pip"):
        names, usual = source_names(specs), "|" if kind == "pip" else ","
        if kind == "pip" and header is None:
            header = False
        if header and delimiter is None and not names:
            delimiter = usual
        if header is None or delimiter is None:
            return read_dialect(spark, path, names, detect_dialect(spark, path, names, usual, header, delimiter))
        if not header and not names:
            raise ValueError(f"files without a header need column names: {path}")
        return read_delimited(spark, path, delimiter) if header else read_headerless(spark, path, names, delimiter)
    if kind == "xml":
        return read_xml(spark, path, row_tag, schema)
    if kind == "json":
        return read_json(spark, path, schema, array_file)
    raise ValueError(f"no reader for files with extension {kind}")


def has_files(spark: SparkSession, path: str) -> bool:
    """Does the path hold anything that Spark would read? Asks the file system, reads nothing."""
    return bool(children(spark, path))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's outermost partition column, from its folder names."""
    mark = f"{column}="
    names = [child.rpartition("/")[2] for child in children(spark, path)]
    return sorted(n[len(mark):] for n in names if n.startswith(mark))


def remove_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Delete one partition folder."""
    location, system = file_system(spark, f"{path.rstrip('/')}/{column}={value}")
    system.delete(location, True)


def read_target(spark: SparkSession, path: str, partition_column: str | None = None) -> DataFrame | None:
    """The current target without its partition column, or None before the first load. A change that was decided and not
    carried out, as its driver was lost, is finished first."""
    settle(spark, path)
    if not has_files(spark, path):
        return None
    target = spark.read.parquet(path)
    return target.drop(partition_column) if partition_column else target


def latest_file_date(spark: SparkSession, prefix: str) -> DataFrame:
    """One row: the newest `yyyyMMdd` in the names of the files below a prefix."""
    digits = F.regexp_extract("path", r"(\d{8})(?!.*\d{8})", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix).select("path")
    return files.agg(F.max(F.try_to_date(digits, "yyyyMMdd")).alias("last_date"))


# The shape of a nested series.
SERIES_SCHEMA = (
    "OrganizationName string, CurrencyName string, "
    "AccountData array<struct<AccountName: string, AccountIdentifier: string, Data: array<{record}>>>"
)


def flatten_series(df: DataFrame, series: str | Column, record: str = "struct<FiscalYear: string, NativeAmount: double>") -> DataFrame:
    """One row per data point of a nested series text, with its account, organisation and currency."""
    text = F.col(series) if isinstance(series, str) else series
    parsed = df.select(F.from_json(text, SERIES_SCHEMA.format(record=record)).alias("s"))
    accounts = parsed.select("s.OrganizationName", "s.CurrencyName", F.explode("s.AccountData").alias("a"))
    points = accounts.select("*", F.explode("a.Data").alias("d"))
    return points.select(
        "d.*",
        F.col("a.AccountName"),
        F.col("a.AccountIdentifier").alias("AccountID"),
        F.col("OrganizationName").alias("Org Name"),
        "CurrencyName",
    )
