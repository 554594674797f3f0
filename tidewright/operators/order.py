"""Row numbers, prefix sums, ranks and batches over a total order.

A window without partition keys would put the whole table in one task. Here
the table is range-sorted, each row notes its partition and its place in it, and
the result is checkpointed so that the placement is fixed data: a retried task
cannot sort differently. What remains is one number per partition to add.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on, value_key
from tidewright.session import cut


def _placed(df: DataFrame, order_by) -> DataFrame:
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    return cut(df.orderBy(*order_by).withColumn("_part", part).withColumn("_place", place))


def _part_starts(sizes: DataFrame, amounts: list[str]) -> DataFrame:
    """Running totals before each partition; one row per partition, so one task is enough."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "_part",
        *[F.coalesce(F.sum(a).over(before), F.lit(0)).cast("long").alias(f"_start_{a}") for a in amounts],
    )


def row_index(df: DataFrame, order_by, name: str = "row_idx") -> DataFrame:
    """0-based place of each row in the total order ``order_by``."""
    placed = _placed(df, _as_list(order_by))
    sizes = placed.groupBy("_part").agg((F.max("_place") + 1).alias("_n"))
    starts = F.broadcast(_part_starts(sizes, ["_n"]))  # one row per partition
    return (
        placed.join(starts, "_part")
        .withColumn(name, F.col("_start__n") + F.col("_place"))
        .drop("_part", "_place", "_start__n")
    )


def group_index(df: DataFrame, by, order_by, name: str = "row_idx") -> DataFrame:
    """0-based place of each row within its group; groups of any size.

    Groups lie one after another in one total order, so the place in the group
    is the global place less that of the group's first row.
    """
    by, order_by = _as_list(by), _as_list(order_by)
    indexed = row_index(df, [*by, *order_by], "_global")
    firsts = indexed.groupBy(*by).agg(F.min("_global").alias("_first"))
    joined = match_on(indexed, firsts, by, "left")
    return joined.select(*df.columns, (F.col("_global") - F.col("_first")).alias(name))


def prefix_sums(df: DataFrame, order_by, amounts: dict[str, str], by=()) -> DataFrame:
    """Running sums (row included) of non-negative whole numbers, restarted per group.

    ``amounts`` maps new column to summed column. Meant for pre-aggregated
    frames, such as one row for each distinct score.
    """
    by, order_by = list(by), _as_list(order_by)
    names = list(amounts)
    placed = _placed(
        df.select("*", *[F.col(amounts[n]).cast("long").alias(f"_a_{n}") for n in names]), [*by, *order_by]
    )
    within = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    sizes = placed.groupBy("_part").agg(*[F.sum(f"_a_{n}").alias(f"_a_{n}") for n in names])
    starts = F.broadcast(_part_starts(sizes, [f"_a_{n}" for n in names]))  # one row per partition
    running = (
        placed.select("*", *[F.sum(f"_a_{n}").over(within).alias(f"_w_{n}") for n in names])
        .join(starts, "_part")
        .select(*df.columns, *[f"_a_{n}" for n in names],
                *[(F.col(f"_w_{n}") + F.col(f"_start__a_{n}")).alias(n) for n in names])
    )
    if not by:
        return running.select(*df.columns, *names)
    groups = running.groupBy(*by).agg(*[F.min(F.col(n) - F.col(f"_a_{n}")).alias(f"_g_{n}") for n in names])
    joined = match_on(running, groups, by)
    return joined.select(*df.columns, *[(F.col(n) - F.col(f"_g_{n}")).alias(n) for n in names])


def _as_list(cols) -> list:
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def with_chunk_id(df: DataFrame, rows: int, order_by, name: str = "chunk") -> DataFrame:
    """Number the chunks of ``rows`` rows each, in the given order."""
    return row_index(df, order_by, "_idx").withColumn(name, F.floor(F.col("_idx") / rows)).drop("_idx")


def head(df: DataFrame, n: int, order_by) -> DataFrame:
    return df.orderBy(*_as_list(order_by)).limit(n)


def sort(df: DataFrame, cols) -> DataFrame:
    return df.orderBy(*_as_list(cols))


def latest(df: DataFrame, key, ts: str, nulls_last: bool = True) -> DataFrame:
    """The row with the greatest ``ts`` of each key.

    ``max`` of a struct combines before the shuffle, so a key with very many
    rows costs one row per task; a window would collect them. Columns after
    ``ts`` break ties in column order. A missing ``ts`` counts as the oldest, or
    as the newest with ``nulls_last=False``.
    """
    key = _as_list(key)
    rest = [ts, *[c for c in df.columns if c not in key and c != ts]]
    missing = F.col(ts).isNull() if not nulls_last else F.lit(False)
    best = df.groupBy(*key).agg(F.max(F.struct(missing.alias("_none"), *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in key else F.col(f"_row.{c}") for c in df.columns])


def k_best(df: DataFrame, by, score: str, key, k: int, ascending: bool = False) -> DataFrame:
    """The ``k`` best rows of each group; ties go to the smaller key.

    Spark keeps only ``k`` rows per group and task before the shuffle.
    """
    best = F.col(score).asc() if ascending else F.col(score).desc()
    keys = [F.col(c) for c in _as_list(key)]
    by = _as_list(by) if by else [F.lit(1)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(best, *keys)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def top_features(df: DataFrame, score: str, n: int = 40, name: str = "feature") -> DataFrame:
    return df.orderBy(F.col(score).desc(), F.col(name)).limit(n)


def newest(df: DataFrame, ts: str, n: int, tie: str | None = None) -> DataFrame:
    order = [F.col(ts).desc()] + ([F.col(tie)] if tie else [])
    return df.orderBy(*order).limit(n)


def shuffle(df: DataFrame, seed: int, key=None) -> DataFrame:
    """All rows in random order; with ``key`` the order is the same on every run."""
    if key is None:
        return df.orderBy(F.rand(seed))
    return df.orderBy(F.md5(value_key(seed, *_as_list(key))), *_as_list(key))


def batches(df: DataFrame, n: int, order_by, drop_remainder: bool = True, name: str = "batch") -> DataFrame:
    """Batches of ``n`` rows; the last one is left out when short, or kept on request."""
    indexed = row_index(df, order_by, "_idx")
    out = indexed.withColumn(name, F.floor(F.col("_idx") / n))
    if drop_remainder:
        full = indexed.count() // n
        out = out.filter(F.col(name) < full)
    return out.drop("_idx")


def eval_rows(df: DataFrame, n: int, steps: int, order_by) -> DataFrame:
    """Rows covered by ``steps`` full batches."""
    return batches(df, n, order_by).filter(F.col("batch") < steps)


def cap_candidates(df: DataFrame, by, order_by, limit: int) -> DataFrame:
    """Stop after ``limit`` candidates of each group, in the order they are met."""
    window = Window.partitionBy(*_as_list(by)).orderBy(*_as_list(order_by))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= limit).drop("_rank")


def stratified_folds(df: DataFrame, label, key, k: int, seed: int, name: str = "fold") -> DataFrame:
    """Shuffled folds with the same share of each label; two labels may hold all rows."""
    keys = _as_list(key)
    shuffled = df.withColumn("_h", F.md5(value_key(seed, *keys)))
    placed = group_index(shuffled, label, ["_h", *keys], "_idx")
    return placed.withColumn(name, F.pmod(F.col("_idx"), F.lit(k))).drop("_idx", "_h")


def interleave(df: DataFrame, file: str, order_by, name: str = "position") -> DataFrame:
    """One row of each file in turn; ``position`` is the place in the merged order."""
    placed = group_index(df, file, order_by, "_turn")
    return row_index(placed, ["_turn", file], name).drop("_turn")
