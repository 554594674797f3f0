"""Repeatable pseudo-random numbers and key comparison.

Random choices hash the row key with md5, so a rerun after a lost executor, or
another engine, draws the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def value_key(seed, *cols) -> Column:
    """The text ``seed:part:part`` that is hashed for a row."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])


def md5_number(text) -> Column:
    """First 32 bits of the md5 of a text as a long."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_unit(seed, *cols) -> Column:
    """A number in [0, 1) fixed by seed and key columns."""
    return md5_number(value_key(seed, *cols)) / F.lit(float(HASH_RANGE))


def bucket_of(buckets: int, seed, *cols) -> Column:
    """A bucket number fixed by seed and key columns."""
    return F.pmod(md5_number(value_key(seed, *cols)), F.lit(buckets)).cast("long")


def match_on(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join where a null key matches a null key; the key columns come from ``left``."""
    names = {k: f"_match_{k}" for k in keys}
    renamed = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])
    return left.join(renamed, condition, how).drop(*names.values())
