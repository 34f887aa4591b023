"""Conform rows to a declared target schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import cast_or_null
from millrace.operators.project import quoted


@dataclass(frozen=True)
class ColumnSpec:
    """One line of the column inventory."""

    sequence_number: int
    source_column_name: str
    target_column_name: str
    target_datatype: str = "string"
    target_length: int | None = None
    target_precision: int | None = None
    source_datetime_format: str | None = None
    target_datetime_format: str | None = None
    transformation_logic: str | None = None

    @classmethod
    def from_record(cls, record: Mapping[str, object]) -> ColumnSpec:
        """From an inventory record, where every value may be text and '' means absent."""

        def text(name: str) -> str | None:
            value = record.get(name)
            return None if value in (None, "", "null") else str(value)

        def number(name: str) -> int | None:
            value = text(name)
            return None if value is None else int(value)

        return cls(
            sequence_number=int(str(record["sequence_number"])),
            source_column_name=str(record["source_column_name"]),
            target_column_name=str(record["target_column_name"]),
            target_datatype=text("target_datatype") or "string",
            target_length=number("target_length"),
            target_precision=number("target_precision"),
            source_datetime_format=text("source_datetime_format"),
            target_datetime_format=text("target_datetime_format"),
            transformation_logic=text("transformation_logic"),
        )


def in_sequence(specs: Iterable[ColumnSpec]) -> list[ColumnSpec]:
    """The specs by sequence number, compared as numbers (10 after 9)."""
    return sorted(specs, key=lambda s: int(s.sequence_number))


def specs_in_sequence(inventory: DataFrame) -> DataFrame:
    """The same over an inventory table, whose sequence numbers may be text."""
    return inventory.orderBy(F.col("sequence_number").try_cast("int"))


def source_names(specs: Iterable[ColumnSpec]) -> list[str]:
    return [s.source_column_name for s in in_sequence(specs)]


def moment(spec: ColumnSpec, source: Column, is_text: bool) -> Column:
    """The source as a timestamp, kept to the precision of the target format if there is one."""
    if is_text and spec.source_datetime_format:
        parsed = F.try_to_timestamp(source, F.lit(spec.source_datetime_format))
    else:
        parsed = source.try_cast("timestamp")
    if not spec.target_datetime_format:
        return parsed
    shown = F.date_format(parsed, spec.target_datetime_format)
    return F.try_to_timestamp(shown, F.lit(spec.target_datetime_format))


def target_expression(spec: ColumnSpec, source_type: T.DataType) -> Column:
    """The source column, cast to its target type. A cell that does not parse becomes NULL.

    Texts are read by the source format; a date without one is read by its target format.
    """
    source = quoted(spec.source_column_name)
    is_text = isinstance(source_type, T.StringType)
    kind = spec.target_datatype.lower()
    if kind in ("timestamp", "datetime"):
        return moment(spec, source, is_text)
    if kind == "date":
        pattern = spec.source_datetime_format or spec.target_datetime_format
        return F.try_to_date(source, pattern) if is_text and pattern else source.try_cast("date")
    if kind in ("char", "varchar", "varchar2", "string"):
        return source.cast("string")
    if kind == "decimal" and spec.target_length is not None and spec.target_precision is not None:
        kind = f"decimal({spec.target_length},{spec.target_precision})"
    return cast_or_null(source, kind, source_type)


def conform(df: DataFrame, specs: Iterable[ColumnSpec], change_indicator: str | None = None) -> DataFrame:
    """Project to the target columns, in sequence order; the change indicator passes through if present."""
    columns = [
        target_expression(s, df.schema[s.source_column_name].dataType).alias(s.target_column_name)
        for s in in_sequence(specs)
    ]
    if change_indicator and change_indicator in df.columns:
        columns.append(quoted(change_indicator))
    return df.select(*columns)


def unparsed_cells(df: DataFrame, specs: Iterable[ColumnSpec]) -> DataFrame:
    """Per target column, how many source values were present but could not be cast."""
    specs = in_sequence(specs)

    def is_lost(spec: ColumnSpec) -> Column:
        target = target_expression(spec, df.schema[spec.source_column_name].dataType)
        return quoted(spec.source_column_name).isNotNull() & target.isNull()

    lost = [F.count_if(is_lost(s)).alias(s.target_column_name) for s in specs]
    counts = df.agg(*lost)
    pairs = [F.struct(F.lit(s.target_column_name).alias("column_name"), quoted(s.target_column_name).alias("unparsed"))
             for s in specs]
    return counts.select(F.inline(F.array(*pairs)))
