"""Previous and next row of a key, and the first arrival in a series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on
from tidewright.functions.times import epoch_seconds
from tidewright.functions.vectors import status_code
from tidewright.operators.order import _as_list
from tidewright.operators.skew import HOT_ROWS, carry_over, slice_hot

LAST_EVENT_SENTINEL = 3_000_000_000


def _neighbour(df, keys, order_by, value, forward, name, hot_rows, slices):
    """Add ``value`` of the neighbouring row of the key as ``name``, null at the end."""
    sliced, split = slice_hot(df, keys, order_by, hot_rows, slices)
    window = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    shift = F.lead if forward else F.lag
    if not split:
        return sliced.withColumn(name, shift(value).over(window)).drop("_slice")
    near = sliced.withColumn(name, shift(value).over(window)).withColumn(
        "_edge", shift(F.lit(True)).over(window).isNull()
    )
    beyond = carry_over(sliced, keys, order_by, value, forward, "_beyond")
    joined = match_on(near, beyond, [*keys, "_slice"], "left")
    filled = F.when(F.col("_edge") & F.col("_found"), F.col("_beyond")).otherwise(F.col(name))
    return joined.select(*df.columns, filled.alias(name))


def next_gap(
    df: DataFrame, key, ts: str, id: str, sentinel: int = LAST_EVENT_SENTINEL,
    name: str = "next_gap", hot_rows: int = HOT_ROWS, slices: int | None = None,
) -> DataFrame:
    """Whole seconds to the next event of the same key; the last one gets ``sentinel - t``."""
    timed = df.withColumn("_t", epoch_seconds(F.col(ts)))
    out = _neighbour(timed, _as_list(key), [ts, id], "_t", True, "_next", hot_rows, slices)
    gap = F.coalesce(F.col("_next"), F.lit(sentinel)) - F.col("_t")
    return out.select(*df.columns, gap.alias(name))


def previous(
    df: DataFrame, key, order_by, col: str, default=0, name: str = "previous",
    hot_rows: int = HOT_ROWS, slices: int | None = None,
) -> DataFrame:
    """``col`` of the row before; ``default`` for the first row of a key."""
    marked = df.withColumn("_cell", F.struct(F.col(col).alias("v")))
    out = _neighbour(marked, _as_list(key), _as_list(order_by), "_cell", False, "_prev", hot_rows, slices)
    filled = F.when(F.col("_prev").isNull(), F.lit(default)).otherwise(F.col("_prev.v"))
    return out.select(*df.columns, filled.alias(name))


def first_arrival(
    df: DataFrame, series, ts: str, cloud: str, water: str,
    hot_rows: int = HOT_ROWS, slices: int | None = None,
) -> DataFrame:
    """First time a series turns from clear-and-dry to clear-and-wet.

    ``found_at`` is that time. ``status`` is 0 with a find or without one, -1
    when the first clear observation is already wet or the only one, and null
    when none is clear. ``found_at`` is kept only for status 0.
    """
    keys = _as_list(series)
    coded = df.withColumn("_code", status_code(cloud, water))
    stepped = previous(coded, keys, ts, "_code", 0, "_before", hot_rows, slices)
    clear = F.col("_code") < 10
    arrived = clear & (F.col("_code") - F.col("_before") == 1)
    summary = stepped.groupBy(*keys).agg(
        F.min(F.when(arrived, F.col(ts))).alias("_at"),
        F.min(F.when(clear, F.struct(ts, "_code"))).alias("_first"),
        F.count(F.when(clear, 1)).alias("clear_n"),
    )
    blocked = (F.col("_first._code") == 1) | (F.col("clear_n") == 1)
    status = F.when(F.col("clear_n") > 0, F.when(blocked, -1).otherwise(0))
    return summary.select(
        *keys, status.cast("int").alias("status"),
        F.when(status == 0, F.col("_at")).alias("found_at"), "clear_n",
    )
