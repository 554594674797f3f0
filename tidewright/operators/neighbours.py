"""Mutual information with a class by the distance to near neighbours of the same class.

Each value finds its k-th neighbour among the values of its class in sorted order, where neighbours lie within k places: the
order is cut into chunks of fixed size, and k rows of either side go along with each chunk. How many values of any class lie
nearer is a difference of two places in the order of all values, found by one running sum over values and interval ends.
Equal values of a class are counted first: they share distance and place, and k + 1 of them stand for any number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on
from tidewright.operators.order import prefix_sums, row_index
from tidewright.session import stored

#: Rows of a chunk of the sorted values.
CHUNK = 100_000


def digamma(x: Column) -> Column:
    """The digamma function of a whole number from 1, by its series six places up."""
    x = x.cast("double")
    up = x + 6
    inverse = 1 / (up * up)
    series = F.log(up) - 0.5 / up - inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse / 240)))
    return series - sum((1 / (x + i) for i in range(1, 6)), 1 / x)


def kth_distances(values: np.ndarray, segment: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Distance of each sorted value to its k-th neighbour in its segment; ``k`` by row, less than the segment's size."""
    n, most = len(values), int(k.max(initial=1))
    near = np.full((n, 2 * most), np.inf)
    for j in range(1, min(most, n - 1) + 1):
        same = segment[j:] == segment[:-j]
        gap = np.where(same, values[j:] - values[:-j], np.inf)
        near[j:, 2 * j - 2] = gap
        near[:-j, 2 * j - 1] = gap
    near.sort(axis=1)
    return near[np.arange(n), k - 1]


def neighbour_information(df: DataFrame, cols, label: str, k: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Mutual information (nats, not below 0) of each numeric column with the class, by the k-th neighbour in one dimension.

    Rows without a value or a class take no part, nor does a class of one row; a class of fewer than k + 1 rows takes its last
    neighbour. A value counts as nearer if it is nearer than the k-th neighbour, itself included; at distance 0 all equal values
    count. No noise is added, so tied values stay tied.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols])).alias("p")
    long = df.select(F.col(label).alias("y"), values).select("p.feature", "y", "p.x").where("y IS NOT NULL AND x IS NOT NULL AND NOT isnan(x)")
    counted = stored(long.groupBy("feature", "y", "x").agg(F.count("*").alias("rows")), "values")
    sizes = counted.groupBy("feature", "y").agg(F.sum("rows").alias("size")).where("size > 1")
    copies = F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(k + 1)).cast("int"))).alias("copy")
    ordered = row_index(match_on(counted, sizes, ["feature", "y"]).select("*", copies), ["feature", "y", "x"], "idx")
    place, own = F.col("idx") % chunk, F.floor(F.col("idx") / chunk)
    before, after = F.when(place < k, own - 1), F.when(place >= chunk - k, own + 1)
    homes = F.filter(F.array(own, before, after), lambda c: c.isNotNull())
    spread = ordered.select("*", own.alias("own"), F.explode(homes).alias("chunk"))

    def distances(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        segment = frame["feature"].ne(frame["feature"].shift()) | frame["y"].ne(frame["y"].shift())
        nearest = np.minimum(k, frame["size"].to_numpy() - 1)
        frame["r"] = kth_distances(frame["x"].to_numpy(), segment.cumsum().to_numpy(), nearest)
        frame["k"] = nearest
        first = (frame["own"] == frame["chunk"]) & (frame["copy"] == 1)
        return frame.loc[first, ["feature", "idx", "x", "rows", "size", "k", "r"]]

    found = stored(spread.groupBy("chunk").applyInPandas(distances, "feature string, idx long, x double, rows long, size long, k long, r double"), "distances")
    # Kind orders what has one value: 0 before the values, 1 the values, 2 behind them.
    exact = F.col("r") == 0
    ends = F.array(
        F.struct(F.col("x").alias("v"), F.lit(1).alias("kind"), F.col("rows").alias("one"), F.lit(0).alias("sign")),
        F.struct((F.col("x") + F.col("r")).alias("v"), F.when(exact, 2).otherwise(0).alias("kind"), F.lit(0).cast("long").alias("one"), F.lit(1).alias("sign")),
        F.struct((F.col("x") - F.col("r")).alias("v"), F.when(exact, 0).otherwise(2).alias("kind"), F.lit(0).cast("long").alias("one"), F.lit(-1).alias("sign")),
    )
    marks = found.select("feature", "idx", F.explode(ends).alias("e")).select("feature", "idx", "e.*")
    running = prefix_sums(marks, ["v", "kind"], {"upto": "one"}, by=["feature"]).where("sign <> 0")
    nearer = running.groupBy("feature", "idx").agg(F.sum(F.col("sign") * F.col("upto")).alias("m"))
    terms = found.join(nearer, ["feature", "idx"])
    n = F.sum("rows")

    def mean(name: str) -> Column:
        return (F.sum(digamma(F.col(name)) * F.col("rows")) / n).alias(name)

    means = terms.groupBy("feature").agg(n.alias("n"), mean("k"), mean("size"), mean("m"))
    return means.select("feature", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("k") - F.col("size") - F.col("m")).alias("mi"))
