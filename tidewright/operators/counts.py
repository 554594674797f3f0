"""Group counts joined back to the rows, histograms and plain counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on
from tidewright.functions.times import time_parts

# The nine key groups of the click counts.
CLICK_COUNT_KEYS = (
    ("ip",),
    ("ip", "day", "hour", "minute"),
    ("os", "device"),
    ("os", "app", "channel"),
    ("ip", "day", "hour"),
    ("ip", "app"),
    ("ip", "app", "os"),
    ("ip", "device"),
    ("app", "channel"),
)


def add_counts(df: DataFrame, cols, name: str | None = None) -> DataFrame:
    """Number of rows that share ``cols``, on each row.

    Aggregate and join rather than a window: the counts combine before the
    shuffle, Spark broadcasts them when they turn out small, and otherwise a
    hot key is split over tasks by the adaptive skew join.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    name = name or "_".join(cols) + "_count"
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    return match_on(df, counts, cols, "left")


#: Finest key groups; the others are rolled up from them and ride on their join.
CLICK_COUNT_CHAINS = (
    (("ip", "day", "hour", "minute"), ("ip", "day", "hour"), ("ip",)),
    (("ip", "app", "os"), ("ip", "app")),
    (("os", "app", "channel"), ("app", "channel")),
    (("os", "device"),),
    (("ip", "device"),),
)


def click_counts(clicks: DataFrame) -> DataFrame:
    """Time parts and the nine count features of a click log.

    The log is aggregated once for each finest key group. Coarser counts are sums of finer
    ones and are joined to those small tables, so five joins with the rows carry all nine.
    """
    timed = clicks.withColumns(time_parts("click_time"))
    out = timed
    for finest, *coarser in CLICK_COUNT_CHAINS:
        counts = timed.groupBy(*finest).agg(F.count(F.lit(1)).alias(_count_name(finest)))
        wide, below, name = counts, counts, _count_name(finest)
        for cols in coarser:
            below = below.groupBy(*cols).agg(F.sum(name).alias(_count_name(cols)))
            name = _count_name(cols)
            wide = match_on(wide, below, cols)
        out = match_on(out, wide, finest, "left")
    return out.select(*timed.columns, *[_count_name(cols) for cols in CLICK_COUNT_KEYS])


def _count_name(cols) -> str:
    return "_".join(cols) + "_count"


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def split_sizes(df: DataFrame, split: str) -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int = 256) -> DataFrame:
    """Counts of equal bins over [lo, hi]; the last bin takes ``hi``, other values are left out."""
    place = F.floor((F.col(col) - lo) / F.lit((hi - lo) / bins))
    inside = df.filter((F.col(col) >= lo) & (F.col(col) <= hi))
    return (
        inside.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
