"""One data-quality run: all active rules of an application, each table scanned once per group of rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.quality import (
    Rule,
    Run,
    error_rows,
    group_rules,
    observed,
    rule_problems,
    rule_scan,
    rule_summary,
    run_log,
)
from millrace.plans.pipelines import FAILURE, SUCCESS
from millrace.sinks.files import write_errors


def scanned(spark: SparkSession, group: tuple[str, str, str], rules: list[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows a group of rules looks at: those of its query, or the key and rule columns of its table."""
    query, table, _ = group
    if query:
        return spark.sql(query, **tables)
    return rule_scan(tables[table] if table in tables else spark.table(table), rules)


def run_rules(
    spark: SparkSession, rules: Iterable[Rule], tables: Mapping[str, DataFrame], run: Run
) -> tuple[DataFrame | None, DataFrame | None, DataFrame]:
    """(error rows, summary per rule, log of the rules that cannot run, which leave the others alone).

    Nothing is computed here: errors and summary run when they are written, and `write_run` logs what it has run.
    """
    errors, summaries, log = [], [], []
    for group, members in group_rules(rules).items():
        for rule in members:
            begun = datetime.now()
            problem = "; ".join(rule_problems(rule))
            if problem:
                log.append((run.execution_id, rule.rule_id, begun, datetime.now(), FAILURE, problem))
        runnable = [r for r in members if not rule_problems(r)]
        if runnable:
            rows = scanned(spark, group, runnable, tables)
            errors.append(error_rows(rows, runnable, run))
            summaries.append(rule_summary(rows, runnable))
    union = lambda frames: reduce(lambda a, b: a.union(b), frames) if frames else None
    return union(errors), union(summaries), run_log(spark, log)


SUMMARY = "rule_id string, checked long, failing long, success boolean"


def write_run(
    spark: SparkSession, rules: Iterable[Rule], tables: Mapping[str, DataFrame], run: Run, path: str
) -> tuple[DataFrame, DataFrame]:
    """Append the error rows of a run to the error table; return (summary per rule, run log).

    Rules that look at one row cost a single pass over their table: failing rows and counts come from the same scan.
    A group that fails is logged and leaves the others alone.
    """
    lines, log = [], []
    for group, members in group_rules(rules).items():
        by_row = [r for r in members if r.kind != "unique"]
        for batch in filter(None, [by_row, *([r] for r in members if r.kind == "unique")]):
            begun, problem = datetime.now(), ""
            try:
                rows = scanned(spark, group, batch, tables)
                if batch is by_row:
                    measured, observation = observed(rows, batch, f"rules-{uuid4().hex}")
                    write_errors(error_rows(measured, batch, run), path)
                    found = observation.get
                    checked = found["__checked"]
                    lines += [(r.rule_id, checked, found[r.rule_id], found[r.rule_id] == 0) for r in batch]
                else:
                    write_errors(error_rows(rows, batch, run), path)
                    lines += [tuple(line) for line in rule_summary(rows, batch).collect()]
            except Exception as error:  # noqa: BLE001 - one bad rule must not stop the run
                problem = str(error)
            outcome = FAILURE if problem else SUCCESS
            log += [(run.execution_id, r.rule_id, begun, datetime.now(), outcome, problem) for r in batch]
    return spark.createDataFrame(lines, SUMMARY), run_log(spark, log)
