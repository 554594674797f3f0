"""Equi joins, anti joins, lookups and parameter grids."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.text import non_blank_text
from tidewright.operators.order import _as_list, row_index
from tidewright.operators.select import drop_incomplete


def inner_on(a: DataFrame, b: DataFrame, keys, complete: bool = False) -> DataFrame:
    """Inner join on shared keys; ``complete`` also drops rows with any null."""
    joined = a.join(b, _as_list(keys))
    return drop_incomplete(joined) if complete else joined


def new_only(staged: DataFrame, tracked: DataFrame, key) -> DataFrame:
    """Distinct staged rows whose key is not tracked yet; a null key counts as new."""
    return staged.distinct().join(tracked.select(*_as_list(key)), _as_list(key), "left_anti")


def pending(tracking: DataFrame, status: DataFrame, key, done: str = "loaded", path: str | None = None) -> DataFrame:
    """Tracked rows without a ``done`` status; with ``path`` blank paths are left out."""
    rows = tracking.filter(non_blank_text(path)) if path else tracking
    finished = status.filter(F.col("action_type") == done).select(*_as_list(key))
    return rows.join(finished, _as_list(key), "left_anti")


def pending_staged(staged: DataFrame, tracking: DataFrame, status: DataFrame,
                   path: str = "file_location", key: str = "load_id", done: str = "loaded") -> DataFrame:
    """How many distinct staged files have no ``done`` status."""
    tracked = staged.distinct().join(tracking.select(path, key), path, "left")
    finished = status.filter(F.col("action_type") == done).select(key)
    return tracked.join(finished, key, "left_anti").agg(F.count(F.lit(1)).alias("pending"))


def holdout(df: DataFrame, train: DataFrame, key) -> DataFrame:
    """Rows whose key is not in the training sample."""
    return df.join(train.select(*_as_list(key)), _as_list(key), "left_anti")


def lookup(df: DataFrame, dim: DataFrame, key) -> DataFrame:
    """Add the columns of a dimension; Spark broadcasts it when its size allows."""
    return df.join(dim, _as_list(key), "left")


def dense_position(dim: DataFrame, order_by, name: str = "position") -> DataFrame:
    """Number the rows of a dimension from 0 in the given order."""
    return row_index(dim, order_by, name)


def glue(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Columns of two aligned tables side by side, matched by row key."""
    return a.join(b, _as_list(key))


def param_grid(spark, params: dict[str, list]) -> DataFrame:
    """One row for each combination of the parameter values."""
    names = list(params)
    rows = [(i, *combo) for i, combo in enumerate(product(*params.values()))]
    return spark.createDataFrame(rows, ["trial", *names])


def for_each_param(df: DataFrame, params: dict[str, list]) -> DataFrame:
    """Each row once per parameter combination, as an exploded literal array (no join)."""
    combos = [
        F.struct(F.lit(i).alias("trial"), *[F.lit(v).alias(n) for n, v in zip(params, combo)])
        for i, combo in enumerate(product(*params.values()))
    ]
    return df.select("*", F.explode(F.array(*combos)).alias("_p")).select(*df.columns, "_p.*")


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def one_per(df: DataFrame, keys, order_by) -> DataFrame:
    """One row of each key, the first in the given order; combines before the shuffle."""
    keys, order_by = _as_list(keys), _as_list(order_by)
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def unseen(all_values: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct values that were never seen."""
    return all_values.select(*seen.columns).subtract(seen)


def distinct_keys(df: DataFrame, key) -> DataFrame:
    return df.select(*_as_list(key)).distinct()
