"""Column expressions shared by the operators. All stay inside Spark's code generation except `python_udf`."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as "no value" when looking for the first meaningful one.
SENTINELS = ["NR", "WR", "WD", "PIF", "nan", "NaN", "NULL", "", "N/A"]

# Community names of the catalog, by business domain.
COMMUNITY_BY_DOMAIN = {
    "esg": "DataLake_ESG",
    "oem": "DataLake_OEM",
    "external": "DataLake_External",
    "finance": "DataLake_Finance",
    "cross": "DataLake_Cross",
    "reference": "DataLake_Reference",
    "ratings": "DataLake_Ratings",
}

# Type names of the catalog, replaced in this order, each one inside the result of the one before.
RAW_TYPE_NAMES = [
    ("timestamp", "Date Time"),
    ("string", "Text"),
    ("int", "Whole Number"),
    ("boolean", "True/False"),
    ("datetime", "Date Time"),
    ("bigDecimal Number", "Decimal Number"),
    ("bigWhole Number", "Whole Number"),
    ("date", "Date"),
    ("decimal", "Decimal Number"),
    ("varchar", "Text"),
    ("double", "Decimal Number"),
    ("char", "Text"),
    ("smallWhole Number", "Whole Number"),
]
# The processed feed uses the first nine only.
PROCESSED_TYPE_NAMES = RAW_TYPE_NAMES[:9]

# The three families a type name can belong to; any other name counts as a date.
NUMBER_TYPES = ["int", "decimal"]
STRING_TYPES = ["char", "varchar", "varchar2", "string"]


def to_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Texts that stand for whole numbers and for booleans.
WHOLE_NUMBER = r"^\s*[-+]?\d+\s*$"
BOOLEAN = r"^\s*(?i:t|true|y|yes|1|f|false|n|no|0)\s*$"


def cast_or_null(source: Column, target: T.DataType | str, source_type: T.DataType | None = None) -> Column:
    """A cast that gives NULL for what does not parse.

    A failed cast of text to a whole number or a boolean is slow in Spark (it raises inside), so texts are tested by
    pattern first when the source is known to be text.
    """
    kind = target if isinstance(target, str) else target.simpleString()
    cast = source.try_cast(target)
    if not isinstance(source_type, T.StringType):
        return cast
    if kind in ("tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"):
        return F.when(source.rlike(WHOLE_NUMBER), cast)
    if kind == "boolean":
        return F.when(source.rlike(BOOLEAN), cast)
    return cast


def first_meaningful(*values: str | Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The first value, left to right, that is neither NULL nor one of the sentinels, as a string."""

    def cleaned(value: str | Column) -> Column:
        text = to_column(value).cast("string")
        return F.when(~text.isin(*sentinels), text)

    return F.coalesce(*[cleaned(v) for v in values])


def lookup(value: str | Column, table: dict[str, str]) -> Column:
    """Map a value through a small fixed table; values not in it stay as they are."""
    col = to_column(value)
    mapped = F.lit(None).cast("string")
    for key, label in reversed(table.items()):
        mapped = F.when(col == key, F.lit(label)).otherwise(mapped)
    return F.coalesce(mapped, col)


def community_name(domain: str | Column) -> Column:
    return lookup(domain, COMMUNITY_BY_DOMAIN)


def catalog_type_name(type_name: str | Column, replacements: Sequence[tuple[str, str]] = RAW_TYPE_NAMES) -> Column:
    """Turn `bigint`, `varchar`, ... into catalog names by ordered substring replacement."""
    result = to_column(type_name)
    for old, new in replacements:
        result = F.replace(result, F.lit(old), F.lit(new))
    return result


def decimal_part(type_name: str | Column, group: int) -> Column:
    """Length (1) or precision (2) out of a text such as `decimal(10,2)`; NULL for other types."""
    found = F.regexp_extract(to_column(type_name), r"^decimal\((\d+)(?:,\s*(\d+))?", group)
    return F.nullif(found, F.lit(""))


def type_family(type_name: str | Column) -> Column:
    name = F.lower(to_column(type_name))
    return (
        F.when(name.isin(*NUMBER_TYPES), F.lit("number"))
        .when(name.isin(*STRING_TYPES), F.lit("string"))
        .otherwise(F.lit("date"))
    )


def drop_last(text: str | Column, count: int) -> Column:
    """`text` without its last `count` characters; '' when it is shorter than that."""
    col = to_column(text)
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - count, F.lit(0)))


def seconds_of(clock: str | Column) -> Column:
    """`HH:MM:SS` as seconds; NULL when it does not parse."""
    parts = F.split(to_column(clock), ":")
    hours, minutes, seconds = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def json_of(names: Iterable[str]) -> Column:
    """The named columns as one JSON object; NULL fields are kept so that every object has the same keys."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def any_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def all_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def python_udf(
    function: Callable, return_type: T.DataType | str, columns: Sequence[str | Column], vectorised: bool = False
) -> Column:
    """A user's Python function over columns. The return type is required: nothing falls back to string.

    Values travel in Arrow batches; with `vectorised` the function gets them as pandas Series instead of one by one.
    """
    made = F.pandas_udf(function, return_type) if vectorised else F.udf(function, return_type, useArrow=True)
    return made(*[to_column(c) for c in columns])


def json_value(text: str | Column, path: str, data_type: T.DataType | str) -> Column:
    """The value at a dotted path of a JSON object, NULL where it is absent or of another type. One field is parsed, not the
    whole object."""
    names = path.split(".")
    kind = data_type if isinstance(data_type, str) else data_type.simpleString()
    schema = kind
    for name in reversed(names):
        schema = f"struct<`{name}`: {schema}>"
    found = F.from_json(to_column(text), schema)
    for name in names:
        found = found[name]
    return found
