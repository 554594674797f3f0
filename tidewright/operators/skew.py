"""Slices for ordered windows over keys that hold very many rows."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on
from tidewright.session import cut

#: Rows beyond which a key is cut; also about the rows of a slice.
HOT_ROWS = 5_000_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None when there are none.

    Counts combine before the shuffle, and at most ``rows / hot_rows`` keys
    can come out.
    """
    found = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows))
    return None if found.isEmpty() else found


def slice_hot(
    df: DataFrame, keys: list[str], order_by: list[str], hot_rows: int = HOT_ROWS, slices: int | None = None
) -> tuple[DataFrame, bool]:
    """Add ``_slice``: 0 for ordinary keys, an increasing range of ``order_by`` for hot ones.

    Slice limits are quantiles of the first order column over the rows of hot
    keys, so a (key, slice) group holds about ``hot_rows`` rows however many
    a single key has; ``slices`` sets their number by hand. A value that takes up
    several slices is cut further at quantiles of the second order column, if that is a number.
    """
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df.withColumn("_slice", F.lit(0)), False
    if slices is None:
        slices = 2 * math.ceil(hot.agg(F.sum("_n")).first()[0] / hot_rows)
    joined = match_on(df, hot.select(*keys, F.lit(True).alias("_hot")), keys, "left")
    marked = joined.select(*df.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"), _number(df, order_by[0]).alias("_pos"))
    cuts = marked.filter("_hot").approxQuantile("_pos", [i / slices for i in range(1, slices)], 0.5 / slices)
    if not cuts:
        return df.withColumn("_slice", F.lit(0)), False
    place = Bucketizer(splits=[float("-inf"), *sorted(set(cuts)), float("inf")], inputCol="_pos", outputCol="_bucket").transform(marked)
    tied = {value: n for value, n in Counter(cuts).items() if n > 1}
    within = F.lit(0)
    if tied and len(order_by) > 1 and _is_number(df, order_by[1]):
        place = place.withColumn("_id", _number(df, order_by[1]))
        for value, n in tied.items():
            rows = place.filter(F.col("_hot") & (F.col("_pos") == value))
            limits = sorted(set(rows.approxQuantile("_id", [i / n for i in range(1, n)], 0.5 / n)))
            passed = sum([(F.col("_id") > v).cast("int") for v in limits], F.lit(0))
            after = F.col("_bucket") == sorted(set(cuts)).index(value) + 1
            within = F.when(F.col("_pos") == value, passed).when(after, F.lit(len(limits) + 1)).otherwise(within)
    wide = max(tied.values(), default=1) + 2
    number = (F.col("_bucket").cast("int") * wide + within + 1).cast("int")
    return place.withColumn("_slice", F.when(F.col("_hot"), number).otherwise(F.lit(0))).drop("_hot", "_pos", "_bucket", "_id"), True


def _is_number(df: DataFrame, name: str) -> bool:
    kind = dict(df.dtypes)[name]
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith(("timestamp", "decimal"))


def _number(df: DataFrame, name: str):
    """A column as a double that keeps its order; null sorts first."""
    is_time = dict(df.dtypes)[name].startswith("timestamp")
    number = F.unix_micros(F.col(name).cast("timestamp")) if is_time else F.col(name)
    return F.coalesce(number.cast("double"), F.lit(-1e300))


def carry_over(
    sliced: DataFrame, keys: list[str], order_by: list[str], value: str, forward: bool, name: str
) -> DataFrame:
    """For each slice of a hot key, ``value`` at the nearest row beyond its end.

    ``forward`` looks at the first row of the next slice, else at the last row
    of the slice before. One row per slice takes part.
    """
    edge = F.struct(*order_by, F.col(value).alias("_value"))
    edges = (
        sliced.filter(F.col("_slice") > 0)
        .groupBy(*keys, "_slice")
        .agg((F.min(edge) if forward else F.max(edge)).alias("_edge"))
    )
    window = Window.partitionBy(*keys).orderBy("_slice")
    shifted = F.lead("_edge").over(window) if forward else F.lag("_edge").over(window)
    edges = edges.withColumn("_shifted", shifted).filter(F.col("_shifted").isNotNull())
    return edges.select(*keys, "_slice", F.lit(True).alias("_found"), F.col("_shifted._value").alias(name))
