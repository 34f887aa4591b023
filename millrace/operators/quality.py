"""Expectation rules that report every failing row, constraint checks, and constraint suggestions."""

from __future__ import annotations

import ast
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import json_of
from millrace.operators.joins import semi_join
from millrace.operators.project import as_list, quoted
from millrace.operators.cdc import duplicate_keys

# How a rule's columns and arguments are read: (number of columns, fewest values, most values).
SHAPES = {
    "not_null": (1, 0, 0),
    "unique": (None, 0, 0),
    "in_set": (1, 1, None),
    "between": (1, 2, 2),
    "equal_pair": (2, 0, 0),
    "greater_pair": (2, 0, 0),
    "greater_or_equal_pair": (2, 0, 0),
}

# Fixed value: the columns of the error table, all strings; `run_dt` is its partition.
ERROR_COLUMNS = [
    "app_name",
    "execution_id",
    "domain_name",
    "zone",
    "rule_id",
    "rule_name",
    "db_name",
    "table_name",
    "primary_keys",
]


def literal(text: str) -> object:
    """A number or quoted text as its value, anything else as it stands."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


@dataclass(frozen=True)
class Rule:
    """One line of the rule inventory."""

    rule_id: str
    kind: str
    columns: tuple[str, ...]
    key_columns: tuple[str, ...]
    values: tuple = ()
    rule_name: str = ""
    app_name: str = ""
    domain_name: str = ""
    zone: str = ""
    db_name: str = ""
    table_name: str = ""
    query: str = ""
    active: bool = True


    @classmethod
    def from_record(cls, record: Mapping[str, str], kind_of: Mapping[str, str]) -> Rule:
        """From a rule inventory row: lists are comma-separated texts, and `kind_of` maps rule names to kinds.

        The second column of a pair rule stands in `user_values`. Values of a set may be written as literals.
        """

        def items(name: str) -> tuple[str, ...]:
            return tuple(part.strip() for part in (record.get(name) or "").split(",") if part.strip())

        kind = kind_of[record["rule_name"]]
        columns, values = items("column"), items("user_values")
        if kind.endswith("_pair"):
            columns, values = columns + values, ()
        elif kind == "between":
            values = tuple(int(v) for v in values)
        elif kind == "in_set":
            values = tuple(literal(v) for v in values)
        return cls(
            rule_id=record["rule_id"],
            kind=kind,
            columns=columns,
            key_columns=items("key_columns"),
            values=values,
            rule_name=record["rule_name"],
            app_name=record.get("app_name") or "",
            domain_name=record.get("domain_name") or "",
            zone=record.get("zone") or "",
            db_name=record.get("schema_name") or "",
            table_name=record.get("table_name") or "",
            query=record.get("query") or "",
            active=str(record.get("active_flag", "true")).lower() in ("true", "y", ""),
        )


@dataclass(frozen=True)
class Run:
    execution_id: str
    run_date: date | str = field(default_factory=date.today)


def rule_problems(rule: Rule) -> list[str]:
    """What is wrong with a rule's definition; empty when nothing is."""
    if rule.kind not in SHAPES:
        return [f"{rule.rule_id}: unknown kind {rule.kind}"]
    width, fewest, most = SHAPES[rule.kind]
    problems = []
    if not rule.columns or (width is not None and len(rule.columns) != width):
        problems.append(f"{rule.rule_id}: {rule.kind} needs {width or 'one or more'} columns")
    if len(rule.values) < fewest:
        problems.append(f"{rule.rule_id}: {rule.kind} has too few values")
    if most is not None and len(rule.values) > most:
        problems.append(f"{rule.rule_id}: {rule.kind} has too many values")
    if not rule.key_columns:
        problems.append(f"{rule.rule_id}: no key columns")
    return problems


def require_valid(rules: Iterable[Rule]) -> list[Rule]:
    chosen = [r for r in rules if r.active]
    problems = [p for r in chosen for p in rule_problems(r)]
    if problems:
        raise ValueError("; ".join(problems))
    return chosen


def row_failure(rule: Rule) -> Column:
    """True where a row breaks the rule. A NULL passes everything except `not_null`."""
    cols = [quoted(c) for c in rule.columns]
    if rule.kind == "not_null":
        return cols[0].isNull()
    if rule.kind == "in_set":
        broken = ~cols[0].isin(*rule.values)
    elif rule.kind == "between":
        broken = ~cols[0].between(*rule.values)
    elif rule.kind == "equal_pair":
        broken = cols[0] != cols[1]
    elif rule.kind == "greater_pair":
        broken = ~(cols[0] > cols[1])
    elif rule.kind == "greater_or_equal_pair":
        broken = ~(cols[0] >= cols[1])
    else:
        raise ValueError(f"{rule.kind} is not decided by one row alone")
    return F.coalesce(broken, F.lit(False))


def rule_scan(table: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Only the key and rule columns of a table, so that the scan reads nothing else."""
    names = dict.fromkeys(c for r in rules if r.active for c in (*r.key_columns, *r.columns))
    return table.select(*[quoted(n) for n in names])


def group_rules(rules: Iterable[Rule]) -> dict[tuple[str, str, str], list[Rule]]:
    """Active rules by (query, table, zone): each group needs one scan."""
    groups: dict[tuple[str, str, str], list[Rule]] = {}
    for rule in rules:
        if rule.active:
            groups.setdefault((rule.query, rule.table_name, rule.zone), []).append(rule)
    return groups


def _report(rule: Rule, run: Run) -> dict[str, Column]:
    texts = {
        "app_name": rule.app_name,
        "execution_id": run.execution_id.replace(".", ""),
        "domain_name": rule.domain_name,
        "zone": rule.zone,
        "rule_id": rule.rule_id,
        "rule_name": rule.rule_name or rule.kind,
        "db_name": rule.db_name,
        "table_name": rule.table_name,
    }
    report = {name: F.lit(text) for name, text in texts.items()}
    report["primary_keys"] = json_of(rule.key_columns)
    return report


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break one rule, with all their columns."""
    require_valid([rule])
    if rule.kind != "unique":
        return df.filter(row_failure(rule))
    return semi_join(df, duplicate_keys(df, rule.columns), rule.columns)


def error_rows(df: DataFrame, rules: Iterable[Rule], run: Run) -> DataFrame:
    """One row per failing record and rule, ready for the error table.

    All rules that look at one row are decided in a single pass over the key and rule columns. A uniqueness rule counts
    its keys (map-side first) and fetches the rows of the repeated ones by a semi-join.
    """
    chosen = require_valid(rules)
    if not chosen:
        raise ValueError("no active rule")
    by_row = [r for r in chosen if r.kind != "unique"]
    frames = []
    if by_row:
        reports = [
            F.when(row_failure(r), F.struct(*[c.alias(n) for n, c in _report(r, run).items()])) for r in by_row
        ]
        failed = df.filter(reduce(lambda a, b: a | b, [row_failure(r) for r in by_row]))
        frames.append(failed.select(F.inline(F.array_compact(F.array(*reports)))))
    for rule in chosen:
        if rule.kind == "unique":
            needed = df.select(*[quoted(c) for c in dict.fromkeys([*rule.key_columns, *rule.columns])])
            frames.append(failing_rows(needed, rule).select(*[c.alias(n) for n, c in _report(rule, run).items()]))
    errors = reduce(lambda a, b: a.union(b), frames)
    return errors.select(*ERROR_COLUMNS, F.lit(str(run.run_date)).alias("run_dt"))


def rule_summary(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Per rule: rows checked, rows failing, and whether it holds. Row rules share one aggregate."""
    chosen = require_valid(rules)
    by_row = [r for r in chosen if r.kind != "unique"]
    frames = []
    if by_row:
        counts = df.agg(
            F.count(F.lit(1)).alias("checked"), *[F.count_if(row_failure(r)).alias(f"f{i}") for i, r in enumerate(by_row)]
        )
        lines = [
            F.struct(F.lit(r.rule_id).alias("rule_id"), F.col("checked"), F.col(f"f{i}").alias("failing"))
            for i, r in enumerate(by_row)
        ]
        frames.append(counts.select(F.inline(F.array(*lines))))
    for rule in chosen:
        if rule.kind == "unique":
            groups = df.groupBy(*[quoted(c) for c in rule.columns]).count()
            no_null = reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in rule.columns])
            zero = F.lit(0).cast("long")
            frames.append(
                groups.agg(
                    F.coalesce(F.sum("count"), zero).alias("checked"),
                    F.coalesce(F.sum(F.when((F.col("count") > 1) & no_null, F.col("count"))), zero).alias("failing"),
                ).select(F.lit(rule.rule_id).alias("rule_id"), "checked", "failing")
            )
    return reduce(lambda a, b: a.union(b), frames).withColumn("success", F.col("failing") == 0)


def observed(df: DataFrame, rules: Iterable[Rule], name: str) -> tuple[DataFrame, Observation]:
    """The table with the counts of its row rules measured on the way, whenever it is next read in full."""
    by_row = [r for r in require_valid(rules) if r.kind != "unique"]
    observation = Observation(name)
    counts = [F.count_if(row_failure(r)).alias(r.rule_id) for r in by_row]
    return df.observe(observation, F.count(F.lit(1)).alias("__checked"), *counts), observation


# The columns of the rule tracker.
RUN_LOG = (
    "execution_id string, rule_id string, execution_start_time timestamp, execution_end_time timestamp, "
    "execution_status string, error_message string"
)


def run_log(spark: SparkSession, entries: Sequence[tuple]) -> DataFrame:
    """The log of a run, one entry per rule, for appending to the tracker table."""
    return spark.createDataFrame(list(entries), RUN_LOG)


# --- constraints -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    """A named check on a column. `value` is the least ratio, the allowed values, or the type name."""

    name: str
    column: str
    value: object = None

    def label(self) -> str:
        extra = "" if self.value is None else f", {self.value}"
        return f"{self.name}({self.column}{extra})"


# How a text looks when it stands for a value of a type.
TYPE_PATTERNS = {
    "Boolean": r"^(true|false)$",
    "Integral": r"^[-+]?\d+$",
    "Fractional": r"^[-+]?\d*\.?\d+([eE][-+]?\d+)?$",
}


def _ratio_of(constraint: Constraint) -> tuple[Column, Column]:
    """(share of rows that meet the constraint, least share that is enough)."""
    col = quoted(constraint.column)
    rows = F.count(F.lit(1))
    full = F.lit(1.0)
    if constraint.name == "isComplete":
        return F.try_divide(F.count(col), rows), full
    if constraint.name == "hasCompleteness":
        return F.try_divide(F.count(col), rows), F.lit(float(constraint.value))
    if constraint.name == "isNonNegative":
        return F.try_divide(F.count_if(F.coalesce(col >= 0, F.lit(True))), rows), full
    if constraint.name == "isContainedIn":
        return F.try_divide(F.count_if(F.coalesce(col.isin(*constraint.value), F.lit(True))), rows), full
    if constraint.name == "hasDataType":
        looks = F.rlike(col.cast("string"), F.lit(TYPE_PATTERNS[str(constraint.value)]))
        return F.try_divide(F.count_if(F.coalesce(looks, F.lit(True))), rows), full
    raise ValueError(f"unknown constraint {constraint.name}")


def verify(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Check the constraints: `constraint`, `status`, `value`, `message`, one row each.

    All but the uniqueness checks share one aggregate; no text is evaluated as code.
    """
    shared = [c for c in constraints if c.name != "isUnique"]
    frames = []
    if shared:
        ratios = [_ratio_of(c) for c in shared]
        values = df.agg(*[ratio.alias(f"v{i}") for i, (ratio, _) in enumerate(ratios)])
        lines = [
            F.struct(F.lit(c.label()).alias("constraint"), F.col(f"v{i}").alias("value"), ratios[i][1].alias("least"))
            for i, c in enumerate(shared)
        ]
        frames.append(values.select(F.inline(F.array(*lines))))
    for constraint in constraints:
        if constraint.name == "isUnique":
            groups = df.filter(quoted(constraint.column).isNotNull()).groupBy(quoted(constraint.column)).count()
            unique = F.try_divide(F.sum(F.when(F.col("count") == 1, 1).otherwise(0)), F.sum("count"))
            frames.append(
                groups.agg(unique.alias("value")).select(
                    F.lit(constraint.label()).alias("constraint"), "value", F.lit(1.0).alias("least")
                )
            )
    checked = reduce(lambda a, b: a.union(b), frames)
    # No rows, no violation.
    met = F.coalesce(F.col("value") >= F.col("least"), F.lit(True))
    return checked.select(
        "constraint",
        F.when(met, F.lit("Success")).otherwise(F.lit("Failure")).alias("status"),
        "value",
        F.when(met, F.lit("")).otherwise(F.format_string("value %s is below %s", "value", "least")).alias("message"),
    )


# Size of a distinct-count sketch as a power of two; 12 gives an error of about 1.6 % in a few kilobytes per column.
SKETCH_SIZE = 12
# Fixed value: texts with more different values are not taken for categories.
MOST_CATEGORIES = 120
# Values that a sketch of frequent ones keeps count of; with fewer in a column its counts are exact.
TRACKED = 1024


def _categories(column: str, rows: Column) -> Column:
    """From a sketch of frequent values: (value, count) of the non-null ones, most frequent first, equal ones in order; NULL where
    there are too many, which shows in counts that do not add up to the rows."""
    found = F.col(column)
    counted = F.aggregate(found, F.lit(0).cast("long"), lambda total, x: total + x["count"])
    ordered = F.array_sort(
        F.transform(F.filter(found, lambda x: x["item"].isNotNull()), lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("value")))
    )
    values = F.transform(ordered, lambda x: F.struct(x["value"].alias("value"), (-x["n"]).alias("count")))
    return F.when((counted == rows) & (F.size(values) <= MOST_CATEGORIES), values)


def profile(df: DataFrame, categories: bool = False) -> DataFrame:
    """One row per column: rows, non-null rows, lowest and highest number, distinct estimate, type of texts, and with `categories`
    the values of texts that have few, with their counts.

    One aggregate over the table for all columns; distinct counts and categories are sketches of fixed size.
    """
    measures, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        col = quoted(f.name)
        number = isinstance(f.dataType, T.NumericType)
        text = isinstance(f.dataType, T.StringType)
        measures += [
            F.count(col).alias(f"n{i}"),
            F.min(col.cast("double")).alias(f"lo{i}") if number else F.lit(None).cast("double").alias(f"lo{i}"),
            F.max(col.cast("double")).alias(f"hi{i}") if number else F.lit(None).cast("double").alias(f"hi{i}"),
            F.hll_sketch_estimate(F.hll_sketch_agg(col.cast("string"), F.lit(SKETCH_SIZE))).alias(f"d{i}"),
        ]
        kinds = []
        for kind, pattern in TYPE_PATTERNS.items() if text else ():
            measures.append(F.count_if(F.rlike(col, F.lit(pattern))).alias(f"{kind}{i}"))
            kinds.append(F.when((F.col(f"n{i}") > 0) & (F.col(f"{kind}{i}") == F.col(f"n{i}")), F.lit(kind)))
        values = F.lit(None).cast("array<struct<value: string, count: bigint>>")
        if categories and text:
            sketch = F.call_function("approx_top_k", col, F.lit(MOST_CATEGORIES + 2), F.lit(TRACKED))
            measures.append(sketch.alias(f"top{i}"))
            values = _categories(f"top{i}", F.col("rows"))
        lines.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("rows"),
                F.col(f"n{i}").alias("non_null"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
                F.col(f"d{i}").alias("distinct_estimate"),
                (F.coalesce(*kinds) if kinds else F.lit(None).cast("string")).alias("text_type"),
                *([values.alias("categories")] if categories else []),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*lines)))


# Thresholds of the suggestion rules.
LEAST_COMPLETENESS = 0.2
UNIQUE_TOLERANCE = 0.08
CONFIDENCE_Z = 1.96
MOST_SINGLE = 0.1
MOST_SINGLE_FRACTIONAL = 0.4
COVERED = 0.9


def _least_share(ratio: Column, rows: Column) -> Column:
    """The lower end of a share's 95 % interval, in hundredths."""
    spread = CONFIDENCE_Z * F.sqrt(F.try_divide(ratio * (1 - ratio), rows))
    return F.floor((ratio - spread) * 100) / 100


def _value_rules(rows: Column, filled: Column) -> tuple[Column, Column, Column, Column]:
    """Of a column's categories: whether all of them make a value list and the list, whether the most frequent ones make one that
    covers enough of the rows, and that list with the least share it should cover."""
    values = F.col("categories")
    single = F.try_divide(F.size(F.filter(values, lambda x: x["count"] == 1)), F.size(values))

    def listed(items: Column) -> Column:
        quoted_items = F.transform(items, lambda x: F.concat(F.lit('"'), F.replace(x["value"], F.lit('"'), F.lit('\\"')), F.lit('"')))
        return F.concat(F.lit("["), F.array_join(quoted_items, ", "), F.lit("]"))

    start = F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).alias("n"))
    most = F.aggregate(
        values,
        start,
        lambda at, x: F.when(F.try_divide(at["rows"], filled) < COVERED, F.struct((at["rows"] + x["count"]).alias("rows"), (at["n"] + 1).alias("n"))).otherwise(at),
    )
    share = F.try_divide(most["rows"], filled)
    some = F.concat(listed(F.slice(values, 1, F.greatest(most["n"], F.lit(0)))), F.lit(", "), F.format_string("%.2f", _least_share(share, rows)))
    return single <= MOST_SINGLE, listed(values), (single <= MOST_SINGLE_FRACTIONAL) & (share < 1), some


def suggest(profiled: DataFrame) -> DataFrame:
    """Constraints that a profiled table meets: `column_name`, `suggestion`, `dq_rule`.

    Complete columns stay complete, mostly complete ones keep their ratio (lower end of the 95 % interval), texts that
    all look like one type keep it, numbers without a negative stay so, nearly unique columns are unique. From a profile with
    `categories` also value lists: of texts that have few values which mostly come more than once, and of the most frequent ones
    that make up nine tenths of the rows.
    """
    rows, filled = F.col("rows"), F.col("non_null")
    ratio = F.try_divide(filled, rows)
    least = _least_share(ratio, rows)
    name = F.col("column_name")

    def offer(test: Column, text: str, rule: Column) -> Column:
        return F.when(test, F.struct(F.lit(text).alias("suggestion"), rule.alias("dq_rule")))

    lists = []
    if "categories" in profiled.columns:
        whole, every, part, most = _value_rules(rows, filled)
        untyped = F.col("text_type").isNull()
        lists = [
            offer(whole & untyped, "categories", F.format_string('isContainedIn("%s", %s)', name, every)),
            offer(part & untyped, "most categories", F.format_string('isContainedIn("%s", %s)', name, most)),
        ]
    offers = F.array(
        *lists,
        offer(ratio == 1, "complete", F.format_string('isComplete("%s")', name)),
        offer(
            (ratio > LEAST_COMPLETENESS) & (ratio < 1),
            "completeness",
            F.format_string('hasCompleteness("%s", %.2f)', name, least),
        ),
        offer(F.col("min_value") >= 0, "non-negative", F.format_string('isNonNegative("%s")', name)),
        offer(
            F.col("text_type").isNotNull(), "type", F.format_string('hasDataType("%s", "%s")', name, F.col("text_type"))
        ),
        offer(
            (ratio == 1) & (F.abs(1 - F.try_divide(F.col("distinct_estimate"), rows)) <= UNIQUE_TOLERANCE),
            "unique",
            F.format_string('isUnique("%s")', name),
        ),
    )
    return profiled.select("column_name", F.inline(F.array_compact(offers)))


def suggest_or_verify(df: DataFrame, constraints: Sequence[Constraint]) -> tuple[DataFrame | None, DataFrame | None]:
    """(suggestions, results): suggestions only where no constraint is configured. Value lists are suggested, but not stored."""
    if constraints:
        return None, verify(df, constraints)
    return storable(suggest(profile(df))), None


def storable(suggestions: DataFrame) -> DataFrame:
    """Suggestions without value lists."""
    return suggestions.filter(~F.startswith("dq_rule", F.lit("isContainedIn(")))


def verify_tables(
    tables: Mapping[str, DataFrame], constraints: Mapping[str, Sequence[Constraint]]
) -> tuple[DataFrame, dict[str, str]]:
    """Verify several tables in one result; a table whose checks cannot be built is reported, not fatal."""
    frames, failures = [], {}
    for name, df in tables.items():
        try:
            frames.append(verify(df, constraints[name]).select(F.lit(name).alias("table_name"), "*"))
        except Exception as error:  # noqa: BLE001 - one bad table must not stop the batch
            failures[name] = str(error)
    if not frames:
        raise ValueError(f"no table could be verified: {failures}")
    return reduce(lambda a, b: a.union(b), frames), failures


# --- keys ------------------------------------------------------------------------------------------------------------


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str | Sequence[str], key: str | Sequence[str]) -> DataFrame:
    """Distinct foreign keys without a parent. NULLs are allowed. Both sides are reduced to keys before the join."""
    names, own = as_list(foreign_key), as_list(key)
    wanted = child.select(*[quoted(n) for n in names]).dropna().distinct()
    have = parent.select(*[quoted(k).alias(n) for k, n in zip(own, names)]).distinct()
    return wanted.join(have, names, "left_anti")


def primary_key_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that are repeated or NULL in a part, with their count."""
    names = as_list(keys)
    broken = reduce(lambda a, b: a | b, [quoted(n).isNull() for n in names], F.col("count") > 1)
    return df.groupBy(*[quoted(n) for n in names]).count().filter(broken)
