"""Bond analytics. `lineitem` plays the index, `supplier` the countries and organisations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import bonds
from millrace.queries import Tables, register
from millrace.sources.files import flatten_series

AS_OF = "1998-01-01"


def index_bonds(t: Tables):
    unknown = (F.col("l_linestatus") == "O") & (F.col("l_tax") == 0)
    table = t.lineitem.select(
        F.col("l_suppkey").alias("Country"),
        F.when(F.col("l_returnflag") == "A", F.lit("SOVEREIGN")).otherwise(F.lit("CORPORATE")).alias("IssrClsL2"),
        F.when(unknown, F.lit("n/a")).otherwise(F.date_format("l_shipdate", "yyyyMMdd")).alias("MaturDate"),
        F.col("l_linenumber").cast("double").alias("Maturity"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("YldMatE"),
        F.col("l_tax").alias("OAStoWrsE"),
        F.col("l_quantity").alias("OutstandE"),
    )
    return bonds.prepared(table)


def enriched(t: Tables):
    countries = t.supplier.select(F.col("s_suppkey").alias("Country"), F.col("s_name").alias("OrganizationName"))
    organisations = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("OrganizationName"),
        F.col("n_name").alias("Region"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("FCSovereignRating"),
    )
    result, _ = bonds.with_organisations(index_bonds(t), countries, organisations)
    return result


BONDS_SQL = (
    "b AS (SELECT n_name AS \"Region\", 'R' || n_regionkey AS \"Rating\", l_returnflag = 'A' AS sov, "
    "CASE WHEN NOT (l_linestatus = 'O' AND l_tax = 0) THEN l_shipdate END AS due, l_linenumber AS mat, "
    "CASE WHEN l_discount > 0 THEN l_discount END AS yld, l_tax AS oas, l_quantity AS w "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"
)


@register(
    f"WITH {BONDS_SQL} SELECT \"Region\", round(sum(yld * w) / sum(w), 6) AS \"Weighted Yield Region\" FROM b WHERE sov GROUP BY 1"
)
def bond_weighted_yield(t: Tables):
    found = bonds.weighted_yield(enriched(t), "Region")
    return found.withColumn("Weighted Yield Region", F.round("Weighted Yield Region", 6))


@register(
    f"WITH {BONDS_SQL} SELECT \"Rating\", round(sum(oas * w) / sum(w), 6) AS \"Weighted OAS to Worst Rating\" FROM b GROUP BY 1"
)
def bond_weighted_spread(t: Tables):
    found = bonds.weighted_spread(enriched(t), "Rating", issuer_class="")
    return found.withColumn("Weighted OAS to Worst Rating", F.round("Weighted OAS to Worst Rating", 6))


@register(
    f"WITH {BONDS_SQL} SELECT \"Region\", round(sum(mat * w) / sum(w), 6) AS \"Weighted Maturity Region\" FROM b WHERE sov GROUP BY 1"
)
def bond_weighted_maturity(t: Tables):
    found = bonds.weighted_maturity(enriched(t), "Region")
    return found.withColumn("Weighted Maturity Region", F.round("Weighted Maturity Region", 6))


def _horizon_sql(months: int) -> str:
    due = f"due <= TIMESTAMP '{AS_OF}' + INTERVAL {months} MONTH"
    return (
        f"round(sum(CASE WHEN {due} THEN w END), 6) AS \"Debt Maturing Within {months} months\", "
        f"round(sum(CASE WHEN {due} AND sov THEN yld * w END) / sum(CASE WHEN {due} AND sov THEN w END), 6) "
        f"AS \"Weighted Yield of Debt Maturing within {months} Months\", "
        f"round(sum(CASE WHEN {due} THEN w END) / sum(w), 6) AS \"Portion of Debt Maturing in {months} months\""
    )


@register(
    f"WITH {BONDS_SQL} SELECT \"Region\", round(sum(CASE WHEN sov THEN yld * w END) / sum(CASE WHEN sov THEN w END), 6) AS \"Weighted Yield Region\", "
    "round(sum(CASE WHEN sov THEN oas * w END) / sum(CASE WHEN sov THEN w END), 6) AS \"Weighted OAS to Worst Region\", "
    "round(sum(CASE WHEN sov THEN mat * w END) / sum(CASE WHEN sov THEN w END), 6) AS \"Weighted Maturity Region\", "
    f"round(sum(w), 6) AS \"Total USD Debt Outstanding\", {_horizon_sql(12)}, {_horizon_sql(24)}, {_horizon_sql(36)} FROM b GROUP BY 1"
)
def bond_report(t: Tables):
    found = bonds.report(enriched(t), "Region", AS_OF)
    return found.select("Region", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in found.columns if c != "Region"])


@register(
    f"WITH {BONDS_SQL} SELECT \"Rating\", round(sum(w), 6) AS \"Total USD Debt Outstanding\", {_horizon_sql(12)} FROM b GROUP BY 1"
)
def bond_maturing_debt(t: Tables):
    found = bonds.maturing_debt(enriched(t), "Rating", AS_OF, months=(12,))
    return found.select("Rating", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in found.columns if c != "Rating"])


INDICATORS = ["click", "view", "purchase"]


@register(
    "SELECT user_id, event_type, event_id, value FROM events WHERE event_type IN ('click', 'view', 'purchase') AND value > 60"
)
def series_panel(t: Tables):
    series = t.events.filter("value > 60").select("user_id", "event_type", "event_id", "value")
    panel, _ = bonds.series_panel(series, t.events.select("user_id"), INDICATORS, "event_type")
    return panel


@register(
    "SELECT u.user_id, x.event_type FROM (SELECT DISTINCT user_id FROM events) u, (VALUES ('click'), ('view'), ('purchase')) x(event_type) "
    "WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = x.event_type AND e.value > 60)"
)
def series_panel_missing(t: Tables):
    series = t.events.filter("value > 60").select("user_id", "event_type", "event_id", "value")
    _, missing = bonds.series_panel(series, t.events.select("user_id"), INDICATORS, "event_type")
    return missing


@register(
    "SELECT CAST(l_linenumber AS VARCHAR) AS \"FiscalYear\", v AS \"NativeAmount\", 'account' AS \"AccountName\", CAST(l_partkey AS VARCHAR) AS \"AccountID\", "
    "CAST(l_orderkey AS VARCHAR) AS \"Org Name\", l_returnflag AS \"CurrencyName\" FROM (SELECT *, unnest([l_quantity, l_extendedprice]) AS v FROM lineitem)"
)
def series_flattened(t: Tables):
    def point(amount: str):
        return F.struct(
            F.col("l_linenumber").cast("string").alias("FiscalYear"), F.col(amount).alias("NativeAmount")
        )

    account = F.struct(
        F.lit("account").alias("AccountName"),
        F.col("l_partkey").cast("string").alias("AccountIdentifier"),
        F.array(point("l_quantity"), point("l_extendedprice")).alias("Data"),
    )
    document = F.struct(
        F.col("l_orderkey").cast("string").alias("OrganizationName"),
        F.col("l_returnflag").alias("CurrencyName"),
        F.array(account).alias("AccountData"),
    )
    return flatten_series(t.lineitem.select(F.to_json(document).alias("series")), "series")
