"""Bond-index analytics: weighted yield, spread and maturity, and maturing debt, by any grouping."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregate import weighted_average, weighted_mean
from millrace.operators.filters import equal_or_all, horizon_end
from millrace.operators.joins import anti_join, enrich, semi_join
from millrace.operators.project import quoted

# Columns of the index table, and its default issuer class.
YIELD = "YldMatE"
SPREAD = "OAStoWrsE"
MATURITY = "Maturity"
WEIGHT = "OutstandE"
MATURITY_DATE = "MaturDate"
ISSUER_CLASS = "IssrClsL2"
SOVEREIGN = "SOVEREIGN"
HORIZONS = (12, 24, 36)


def prepared(bonds: DataFrame) -> DataFrame:
    """The index table with its maturity date parsed; a text that is no date becomes NULL."""
    return bonds.withColumn(MATURITY_DATE, F.try_to_timestamp(quoted(MATURITY_DATE), F.lit("yyyyMMdd")))


def with_organisations(
    bonds: DataFrame,
    countries: DataFrame,
    organisations: DataFrame,
    region: str = "Region",
    rating: str = "FCSovereignRating",
) -> tuple[DataFrame, DataFrame | None]:
    """Country to organisation name to region and rating; also the keys that have no entry."""
    return enrich(
        bonds,
        [
            (countries, "Country", {"OrganizationName": "OrganizationName"}),
            (organisations, "OrganizationName", {region: "Region", rating: "Rating"}),
        ],
        required=True,
    )


def weighted_yield(bonds: DataFrame, group: str, weight: str = WEIGHT, issuer_class: str = SOVEREIGN) -> DataFrame:
    kept = equal_or_all(bonds, ISSUER_CLASS, issuer_class)
    return weighted_average(kept, group, YIELD, weight, f"Weighted Yield {group}")


def weighted_spread(bonds: DataFrame, group: str, weight: str = WEIGHT, issuer_class: str = SOVEREIGN) -> DataFrame:
    kept = equal_or_all(bonds, ISSUER_CLASS, issuer_class)
    return weighted_average(kept, group, SPREAD, weight, f"Weighted OAS to Worst {group}")


def weighted_maturity(bonds: DataFrame, group: str, weight: str = WEIGHT, issuer_class: str = SOVEREIGN) -> DataFrame:
    kept = equal_or_all(bonds, ISSUER_CLASS, issuer_class)
    return weighted_average(kept, group, MATURITY, weight, f"Weighted Maturity {group}")


def _mean_where(value: str, weight: str, test: Column) -> Column:
    return weighted_mean(F.when(test, quoted(value)), F.when(test, quoted(weight)))


def _issuer(issuer_class: str) -> Column:
    return F.lit(True) if issuer_class == "" else quoted(ISSUER_CLASS) == issuer_class


def maturing_measures(
    bonds: DataFrame, as_of: date | str, months: Sequence[int], issuer_class: str = SOVEREIGN, weight: str = WEIGHT
) -> list[Column]:
    """Total debt, and per horizon the debt maturing in it, its share, and its weighted yield.

    Debt counts every issuer; the yield counts the issuer class only.
    """
    total = F.sum(quoted(weight))
    measures = [total.alias("Total USD Debt Outstanding")]
    for n in months:
        due = quoted(MATURITY_DATE) <= horizon_end(bonds, MATURITY_DATE, as_of, n)
        part = F.sum(F.when(due, quoted(weight)))
        measures += [
            part.alias(f"Debt Maturing Within {n} months"),
            _mean_where(YIELD, weight, due & _issuer(issuer_class)).alias(
                f"Weighted Yield of Debt Maturing within {n} Months"
            ),
            F.try_divide(part, total).alias(f"Portion of Debt Maturing in {n} months"),
        ]
    return measures


def maturing_debt(
    bonds: DataFrame, group: str, as_of: date | str, months: Sequence[int] = HORIZONS, issuer_class: str = SOVEREIGN
) -> DataFrame:
    return bonds.groupBy(quoted(group)).agg(*maturing_measures(bonds, as_of, months, issuer_class))


def report(
    bonds: DataFrame,
    group: str,
    as_of: date | str,
    months: Sequence[int] = HORIZONS,
    issuer_class: str = SOVEREIGN,
    weight: str = WEIGHT,
) -> DataFrame:
    """Everything about a grouping side by side.

    All measures are conditional sums over the same groups, so one aggregation gives what would otherwise be an outer
    join of four.
    """
    issuer = _issuer(issuer_class)
    return bonds.groupBy(quoted(group)).agg(
        _mean_where(YIELD, weight, issuer).alias(f"Weighted Yield {group}"),
        _mean_where(SPREAD, weight, issuer).alias(f"Weighted OAS to Worst {group}"),
        _mean_where(MATURITY, weight, issuer).alias(f"Weighted Maturity {group}"),
        *maturing_measures(bonds, as_of, months, issuer_class, weight),
    )


def requested_pairs(organisations: DataFrame, indicators: Sequence[str], indicator: str) -> DataFrame:
    """Every organisation with every indicator of a given, short list. No join is needed for that."""
    listed = F.array(*[F.lit(i) for i in indicators])
    return organisations.distinct().withColumn(indicator, F.explode(listed))


def series_panel(
    series: DataFrame, organisations: DataFrame, indicators: Sequence[str], indicator: str
) -> tuple[DataFrame, DataFrame]:
    """(the series rows of the requested pairs, the pairs that have no row)."""
    keys = [*organisations.columns, indicator]
    pairs = requested_pairs(organisations, indicators, indicator)
    wanted = series.filter(quoted(indicator).isin(*indicators))
    return semi_join(wanted, organisations, organisations.columns), anti_join(pairs, wanted, keys)
