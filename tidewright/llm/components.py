"""Connected components of an edge list by alternating stars.

Every round points the neighbours of each node at the smallest node around it, once
for larger and once for smaller neighbours; the number of rounds grows with the
logarithm of the longest chain. Minima are aggregated before the shuffle and joined back, so no neighbourhood is ever
gathered. Only the convergence test, two numbers, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges(a, b) with a > b, rewired to the minimum of each neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(joined.select("a", F.col("_m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, comp: for each node of edges(a, b), bar the smallest of its component, that smallest node."""
    now = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        seen = mark
        now = store(_star(_star(now, True), False), "stars")
