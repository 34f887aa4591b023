"""Data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.quality import Constraint, Rule, Run
from millrace.plans.quality_run import run_rules
from millrace.queries import Tables, register

ORDER_RULES = [
    Rule("r_in_set", "in_set", ("o_orderstatus",), ("o_orderkey",), ("F", "O"), app_name="sales", table_name="orders"),
    Rule("r_between", "between", ("o_totalprice",), ("o_orderkey",), (1000, 300000), app_name="sales", table_name="orders"),
    Rule("r_not_null", "not_null", ("o_custkey",), ("o_orderkey",), app_name="sales", table_name="orders"),
]
LINE_RULES = [
    Rule("r_unique", "unique", ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber"), app_name="sales", table_name="lineitem"),
    Rule("r_pair", "greater_pair", ("l_discount", "l_tax"), ("l_orderkey", "l_linenumber"), app_name="sales", table_name="lineitem"),
]
RUN = Run("run-1", "2024-02-01")


@register(
    "WITH e AS (SELECT 'r_in_set' AS rule_id, 'in_set' AS rule_name, 'orders' AS table_name, '{\"o_orderkey\":' || o_orderkey || '}' AS "
    "primary_keys FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT 'r_between', 'between', 'orders', "
    "'{\"o_orderkey\":' || o_orderkey || '}' FROM orders WHERE NOT (o_totalprice BETWEEN 1000 AND 300000) "
    "UNION ALL SELECT 'r_not_null', 'not_null', 'orders', '{\"o_orderkey\":' || o_orderkey || '}' FROM orders WHERE o_custkey IS NULL "
    "UNION ALL SELECT 'r_unique', 'unique', 'lineitem', '{\"l_orderkey\":' || l_orderkey || ',\"l_linenumber\":' || l_linenumber || '}' FROM "
    "(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) c FROM lineitem) WHERE c > 1 "
    "UNION ALL SELECT 'r_pair', 'greater_pair', 'lineitem', '{\"l_orderkey\":' || l_orderkey || ',\"l_linenumber\":' || l_linenumber || '}' "
    "FROM lineitem WHERE NOT (l_discount > l_tax)) "
    "SELECT 'sales' AS app_name, 'run-1' AS execution_id, '' AS domain_name, '' AS zone, rule_id, rule_name, '' AS db_name, "
    "table_name, primary_keys, '2024-02-01' AS run_dt FROM e"
)
def dq_error_rows(t: Tables):
    orders = quality.error_rows(quality.rule_scan(t.orders, ORDER_RULES), ORDER_RULES, RUN)
    lines = quality.error_rows(quality.rule_scan(t.lineitem, LINE_RULES), LINE_RULES, RUN)
    return orders.union(lines)


@register(
    "SELECT 'r_in_set' AS rule_id, count(*) AS checked, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS failing, "
    "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0 AS success FROM orders "
    "UNION ALL SELECT 'r_between', count(*), count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 300000), "
    "count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 300000) = 0 FROM orders "
    "UNION ALL SELECT 'r_not_null', count(*), count(*) FILTER (WHERE o_custkey IS NULL), count(*) FILTER (WHERE o_custkey IS NULL) = 0 "
    "FROM orders UNION ALL SELECT 'r_unique', count(*), count(*) FILTER (WHERE c > 1), count(*) FILTER (WHERE c > 1) = 0 FROM "
    "(SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) c FROM lineitem) "
    "UNION ALL SELECT 'r_pair', count(*), count(*) FILTER (WHERE NOT l_discount > l_tax), count(*) FILTER (WHERE NOT l_discount > l_tax) = 0 "
    "FROM lineitem"
)
def dq_rule_summary(t: Tables):
    return quality.rule_summary(t.orders, ORDER_RULES).union(quality.rule_summary(t.lineitem, LINE_RULES))


@register("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_discount > l_tax)")
def dq_pair_rule(t: Tables):
    return quality.failing_rows(t.lineitem, LINE_RULES[1]).select("l_orderkey", "l_linenumber", "l_partkey")


@register(
    "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) c "
    "FROM lineitem) WHERE c > 1"
)
def dq_unique_rule(t: Tables):
    return quality.failing_rows(t.lineitem, LINE_RULES[0]).select("l_orderkey", "l_linenumber", "l_partkey")


@register(
    "SELECT 'isComplete(o_custkey)' AS \"constraint\", CASE WHEN count(*) = count(o_custkey) THEN 'Success' ELSE 'Failure' END AS status "
    "FROM orders UNION ALL SELECT 'isContainedIn(o_orderstatus, [''F'', ''O''])', CASE WHEN bool_and(o_orderstatus IN ('F', 'O')) "
    "THEN 'Success' ELSE 'Failure' END FROM orders "
    "UNION ALL SELECT 'isUnique(o_orderkey)', CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 'Success' ELSE 'Failure' END FROM orders "
    "UNION ALL SELECT 'hasCompleteness(o_custkey, 0.9)', CASE WHEN count(o_custkey) >= 0.9 * count(*) THEN 'Success' ELSE 'Failure' END FROM orders "
    "UNION ALL SELECT 'hasDataType(o_orderstatus, Integral)', CASE WHEN bool_and(regexp_matches(o_orderstatus, '^[0-9]+$')) "
    "THEN 'Success' ELSE 'Failure' END FROM orders "
    "UNION ALL SELECT 'isUnique(l_orderkey)', CASE WHEN count(*) = count(DISTINCT l_orderkey) THEN 'Success' ELSE 'Failure' END FROM lineitem "
    "UNION ALL SELECT 'isNonNegative(l_tax)', CASE WHEN min(l_tax) >= 0 THEN 'Success' ELSE 'Failure' END FROM lineitem"
)
def dq_constraint_status(t: Tables):
    checked, _ = quality.verify_tables(
        {"orders": t.orders, "lineitem": t.lineitem},
        {
            "orders": [
                Constraint("isComplete", "o_custkey"),
                Constraint("isContainedIn", "o_orderstatus", ["F", "O"]),
                Constraint("isUnique", "o_orderkey"),
                Constraint("hasCompleteness", "o_custkey", 0.9),
                Constraint("hasDataType", "o_orderstatus", "Integral"),
            ],
            "lineitem": [Constraint("isUnique", "l_orderkey"), Constraint("isNonNegative", "l_tax")],
        },
    )
    return checked.select("constraint", "status")


@register(
    "SELECT 'c_custkey' AS column_name, count(*) AS \"rows\", count(c_custkey) AS non_null, CAST(min(c_custkey) AS DOUBLE) AS min_value, "
    "CAST(max(c_custkey) AS DOUBLE) AS max_value, CAST(NULL AS VARCHAR) AS text_type FROM customer "
    "UNION ALL SELECT 'c_acctbal', count(*), count(c_acctbal), min(c_acctbal), max(c_acctbal), NULL FROM customer "
    "UNION ALL SELECT 'digits', count(*), count(*), NULL, NULL, 'Integral' FROM customer "
    "UNION ALL SELECT 'c_mktsegment', count(*), count(c_mktsegment), NULL, NULL, NULL FROM customer"
)
def dq_profile(t: Tables):
    table = t.customer.select(
        "c_custkey", "c_acctbal", F.col("c_custkey").cast("string").alias("digits"), "c_mktsegment"
    )
    return quality.profile(table).drop("distinct_estimate")


@register(
    "WITH p AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> 'P') AS m, "
    "count(DISTINCT o_orderkey) AS d FROM orders), r AS (SELECT *, m / n AS ratio FROM p) "
    "SELECT 'o_orderkey' AS column_name, 'complete' AS suggestion, 'isComplete(\"o_orderkey\")' AS dq_rule FROM p "
    "UNION ALL SELECT 'o_orderkey', 'non-negative', 'isNonNegative(\"o_orderkey\")' FROM p "
    "UNION ALL SELECT 'o_orderkey', 'unique', 'isUnique(\"o_orderkey\")' FROM p WHERE abs(1 - d / n) <= 0.08 "
    "UNION ALL SELECT 'finished', 'completeness', 'hasCompleteness(\"finished\", ' || "
    "printf('%.2f', floor((ratio - 1.96 * sqrt(ratio * (1 - ratio) / n)) * 100) / 100) || ')' FROM r "
    "UNION ALL SELECT 'price_text', 'complete', 'isComplete(\"price_text\")' FROM p "
    "UNION ALL SELECT 'price_text', 'unique', 'isUnique(\"price_text\")' FROM p WHERE abs(1 - "
    "(SELECT count(DISTINCT round(o_totalprice)) FROM orders) / n) <= 0.08 "
    "UNION ALL SELECT 'price_text', 'type', 'hasDataType(\"price_text\", \"Fractional\")' FROM p "
    "UNION ALL SELECT 'o_orderpriority', 'complete', 'isComplete(\"o_orderpriority\")' FROM p"
)
def dq_suggestions(t: Tables):
    table = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("finished"),
        F.concat(F.round("o_totalprice", 0).cast("long").cast("string"), F.lit(".5")).alias("price_text"),
        "o_orderpriority",
    )
    suggestions, _ = quality.suggest_or_verify(table, [])
    return suggestions


def value_list_sql(name: str, column: str, table: str) -> str:
    """Value lists of one column: all of its values, and the most frequent ones that reach nine tenths of its rows."""
    return (
        f"SELECT '{name}' AS column_name, kind AS suggestion, 'isContainedIn(\"{name}\", [' || vals || ']' || rest || ')' AS dq_rule FROM ("
        f"WITH c AS (SELECT {column} AS v, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1), "
        "o AS (SELECT v, n, coalesce(sum(n) OVER (ORDER BY n DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(n) OVER () AS t, "
        f"(SELECT count(*) FROM {table}) AS r FROM c), m AS (SELECT * FROM o WHERE b / t < 0.9), p AS (SELECT sum(n) / any_value(t) AS p, any_value(r) AS r FROM m) "
        "SELECT 'categories' AS kind, string_agg('\"' || v || '\"', ', ' ORDER BY n DESC, v) AS vals, '' AS rest FROM o "
        "HAVING count(*) FILTER (WHERE n = 1) / count(*) <= 0.1 AND count(*) <= 120 UNION ALL "
        "SELECT 'most categories', string_agg('\"' || v || '\"', ', ' ORDER BY n DESC, v), ', ' || "
        "(SELECT printf('%.2f', floor((p - 1.96 * sqrt(p * (1 - p) / r)) * 100) / 100) FROM p) FROM m "
        "HAVING (SELECT p FROM p) < 1 AND (SELECT count(*) FILTER (WHERE n = 1) / count(*) FROM o) <= 0.4 AND (SELECT count(*) FROM o) <= 120)"
    )


@register(
    " UNION ALL ".join(
        value_list_sql(name, column, "lineitem")
        for name, column in (
            ("l_returnflag", "l_returnflag"),
            ("mostly", "CASE WHEN l_quantity < 48 THEN 'low' WHEN l_linenumber <> 1 THEN l_returnflag END"),
            ("month", "strftime(l_shipdate, '%Y-%m') || 'm'"),
        )
    )
)
def dq_value_suggestions(t: Tables):
    mostly = F.when(F.col("l_quantity") < 48, "low").when(F.col("l_linenumber") != 1, F.col("l_returnflag"))
    table = t.lineitem.select(
        "l_returnflag", mostly.alias("mostly"), F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.lit("m")).alias("month"),
        F.concat(F.lit("k"), F.col("l_orderkey").cast("string")).alias("many"),
    )
    found = quality.suggest(quality.profile(table, categories=True))
    return found.filter(F.startswith("dq_rule", F.lit("isContainedIn(")))


@register(
    "SELECT DISTINCT l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0)"
)
def dq_referential(t: Tables):
    return quality.orphans(t.lineitem, t.supplier.filter("s_acctbal > 0"), "l_suppkey", "s_suppkey")


@register(
    "SELECT l_partkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)
def dq_primary_key(t: Tables):
    return quality.primary_key_violations(t.lineitem, ["l_partkey", "l_suppkey"])


@register(
    "SELECT rule_id, failing FROM (SELECT 'r_in_set' AS rule_id, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS failing FROM orders "
    "UNION ALL SELECT 'r_between', count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 300000) FROM orders "
    "UNION ALL SELECT 'r_unique', count(*) FILTER (WHERE c > 1) FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) c FROM lineitem) "
    "UNION ALL SELECT 'r_pair', count(*) FILTER (WHERE NOT l_discount > l_tax) FROM lineitem "
    "UNION ALL SELECT 'r_query', count(*) FILTER (WHERE o_totalprice NOT BETWEEN 0 AND 400000) FROM orders WHERE o_orderstatus = 'F') WHERE failing > 0"
)
def dq_run(t: Tables):
    by_query = Rule(
        "r_query", "between", ("o_totalprice",), ("o_orderkey",), (0, 400000), query="SELECT * FROM {orders} WHERE o_orderstatus = 'F'"
    )
    tables = {"orders": t.orders, "lineitem": t.lineitem}
    errors, _, _ = run_rules(t.spark, [*ORDER_RULES, *LINE_RULES, by_query], tables, RUN)
    return errors.groupBy("rule_id").agg(F.count(F.lit(1)).alias("failing"))
