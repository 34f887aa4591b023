"""Column-level verbs: select, rename, add, convert, drop."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import cast_or_null, first_meaningful, python_udf

# Fixed value: the row-number column a change feed may carry.
ROW_NUMBER_COLUMN = "rno"

Expression = Column | str | Callable


def as_list(value: str | Iterable[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"no such column: {', '.join(missing)}")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def get_columns(df: DataFrame, *names: str | Sequence[str]) -> DataFrame:
    """Keep the named columns, in the given order."""
    return df.select(*[n for item in names for n in as_list(item)])


def reorder_columns_to_match_target(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.select(*target.columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old to new; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def cut_out(df: DataFrame, names: str | Iterable[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*as_list(names))


def present(field: T.StructField) -> Column:
    """True where the field holds a value: neither NULL nor NaN."""
    col = quoted(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def null_counts(df: DataFrame) -> DataFrame:
    """One row that tells, for every column, how many values are NULL or NaN. One pass over the data."""
    return df.agg(*[F.count_if(~present(f)).alias(f.name) for f in df.schema.fields])


def drop_na_columns(df: DataFrame, how: str = "any") -> DataFrame:
    """Drop the columns in which any value, or every value, is missing.

    One aggregate row decides for all columns, so the table is scanned once whatever its width.
    """
    if how not in ("any", "all"):
        raise ValueError("how must be 'any' or 'all'")
    fields = df.schema.fields
    tests = [
        (F.every(present(f)) if how == "any" else F.some(present(f))).alias(f"keep_{i}")
        for i, f in enumerate(fields)
    ]
    keep = df.agg(*tests).first()
    # An empty table gives NULL: no value is missing, but none is present either.
    empty_default = how == "any"
    return df.select(
        *[quoted(f.name) for i, f in enumerate(fields) if (empty_default if keep[i] is None else keep[i])]
    )


def add_field(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def add_fields(df: DataFrame, fields: Mapping[str, object] | Iterable[tuple[str, object]]) -> DataFrame:
    """Add several constant columns in one projection."""
    return df.withColumns({name: F.lit(value) for name, value in dict(fields).items()})


def evaluate(
    expression: Expression,
    columns: Sequence[str] = (),
    return_type: T.DataType | str | None = None,
    vectorised: bool = False,
) -> Column:
    """A Column, an SQL text, or a Python function over `columns`, as a Column. A vectorised function maps pandas Series."""
    if callable(expression) and not isinstance(expression, Column):
        if return_type is None:
            raise ValueError("a Python function needs a return type")
        return python_udf(expression, return_type, columns, vectorised)
    col = F.expr(expression) if isinstance(expression, str) else expression
    return col if return_type is None else col.cast(return_type)


def add_computed_field(
    df: DataFrame,
    name: str,
    expression: Expression,
    columns: Sequence[str] = (),
    return_type: T.DataType | str | None = None,
    vectorised: bool = False,
) -> DataFrame:
    """Add a column computed from others."""
    return df.withColumn(name, evaluate(expression, columns, return_type, vectorised))


def conversion(
    df: DataFrame,
    columns: str | Sequence[str],
    convert: Callable,
    return_type: T.DataType | str,
    python: bool = False,
    vectorised: bool = False,
) -> DataFrame:
    """Replace one or more columns by `convert` of them, cast to `return_type`.

    `convert` maps a Column to a Column; with `python` it maps a value to a value and runs as a UDF,
    with `vectorised` a pandas Series to one.
    """
    names = as_list(columns)
    require_columns(df, names)

    def converted(name: str) -> Column:
        if python or vectorised:
            return python_udf(convert, return_type, [quoted(name)], vectorised)
        source_type = df.select(convert(quoted(name)).alias(name)).schema[name].dataType
        return cast_or_null(convert(quoted(name)), return_type, source_type)

    return df.withColumns({n: converted(n) for n in names})


def conditional_conversion(
    df: DataFrame,
    column: str,
    convert: Callable,
    condition: Column | str,
    return_type: T.DataType | str | None = None,
    vectorised: bool = False,
) -> DataFrame:
    """Convert a column only where the condition holds; rows, their number and their order stay the same.

    With `return_type`, `convert` is a Python function and runs as a UDF, called for the matching rows only. A vectorised one
    maps a pandas Series, whose other rows are null.
    """
    require_columns(df, [column])
    test = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    current = quoted(column)
    if return_type is None:
        changed = convert(current)
    elif vectorised:
        changed = python_udf(convert, return_type, [F.when(test, current)], True)
    else:
        # The UDF sees NULL for rows outside the condition, so `convert` never meets a value it was not meant for.
        changed = python_udf(
            lambda hit, value: convert(value) if hit else None, return_type, [test, current]
        )
    return df.withColumn(column, F.when(test, changed).otherwise(current))


#: A plain number as a text, with or without decimals.
DECIMAL_TEXT = r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)\s*$"


def convert_column_to_float(df: DataFrame, column: str) -> DataFrame:
    return conversion(df, column, lambda c: c, "float")


def convert_column_to_int(df: DataFrame, column: str) -> DataFrame:
    """Whole numbers; of texts with decimals the whole part ('12.7' is 12), and NULL for texts that are no plain number."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return conversion(df, column, lambda c: c, "int")
    return conversion(df, column, lambda c: F.when(c.rlike(DECIMAL_TEXT), c.try_cast("decimal(38,9)")), "int")


def convert_column_to_string(df: DataFrame, column: str) -> DataFrame:
    return conversion(df, column, lambda c: c, "string")


def find_first_non_null_column(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Add the first value among `columns` that is neither NULL nor a "no value" marker."""
    return df.withColumn(name, first_meaningful(*[quoted(c) for c in columns]))


def stringify(df: DataFrame, null_text: str = "NaN") -> DataFrame:
    """Every column as a string, with `null_text` turned into NULL."""
    return df.select(*[F.nullif(quoted(c).cast("string"), F.lit(null_text)).alias(c) for c in df.columns])


def drop_technical_columns(df: DataFrame, change_indicator: str) -> DataFrame:
    return df.drop(change_indicator, ROW_NUMBER_COLUMN)


def labelled(df: DataFrame, labels: Mapping[str, Column | str | None]) -> DataFrame:
    """One projection to a fixed list of labels: Columns are taken as they are, texts and None are constants."""
    return df.select(
        *[(v if isinstance(v, Column) else F.lit(v).cast("string")).alias(k) for k, v in labels.items()]
    )
