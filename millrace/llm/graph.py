"""Connected components of large sparse graphs by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge; others are their own component.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest of them (large star, small
    star), until nothing changes; rounds grow with the logarithm of the longest path. Rows stay as many as edges or fewer.
    Minima are reduced before the shuffle, and joins are inner ones, which adaptive execution splits where a node has very
    many neighbours. Null ends are left out, loops and repeated edges do no harm, no edges give no rows.
    """
    high, low = F.greatest(u, v), F.least(u, v)
    stars = cut(edges.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v))).select(high.alias("hi"), low.alias("lo")).distinct())
    before = None
    while True:
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
        both = stars.unionByName(stars.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.join(least, "hi").where(F.col("lo") > F.col("hi")).select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        stars = cut(joined.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
    roots = stars.select(F.col("lo").alias("node")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.withColumn("component", F.col("node")))


def fresh_name(columns: Iterable[str], name: str) -> str:
    """`name`, with underscores behind it as long as a column has that name, letter case aside."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
