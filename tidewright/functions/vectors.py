"""Arithmetic on array columns, kernels and small array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(a, b) -> Column:
    """Inner product of two arrays, in double precision."""
    return _total(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def squared_distance(a, b) -> Column:
    def square(x, y):
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return _total(F.zip_with(_col(a), _col(b), square))


def distance(a, b) -> Column:
    """Euclidean distance."""
    return F.sqrt(squared_distance(a, b))


def expanded_sq_distance(aa, bb, ab) -> Column:
    """Squared distance from two squared norms and an inner product, never below 0."""
    return F.greatest(_col(aa) + _col(bb) - 2 * _col(ab), F.lit(0.0))


def rbf(sq_distance, sigma) -> Column:
    """Gaussian kernel of a squared distance."""
    sigma = F.lit(float(sigma)) if isinstance(sigma, (int, float)) else _col(sigma)
    return F.exp(-_col(sq_distance) / (sigma * sigma))


def projection_hash(vector, plane, radius: float) -> Column:
    """Bucket number of a vector along one projection of width ``2 * radius``."""
    return F.floor(dot(vector, plane) / F.lit(2.0 * radius))


def log_mean_exp(values) -> Column:
    """Log of the mean of ``exp`` over an array of logs, shifted by the largest."""
    values = _col(values)
    top = F.array_max(values)
    mean = _total(F.transform(values, lambda v: F.exp(v - top))) / F.size(values)
    return F.when(top == float("-inf"), top).otherwise(top + F.log(mean))


def argmax_position(values) -> Column:
    """0-based place of the largest entry; the first one on ties."""
    values = _col(values)
    return F.array_position(values, F.array_max(values)) - 1


def channel_scale(values, mean: float, std: float = 1.0) -> Column:
    """``(v - mean) / std`` for each entry of an array."""
    return F.transform(_col(values), lambda v: (v.cast("double") - F.lit(mean)) / F.lit(std))


def status_code(cloud, value) -> Column:
    """Tens digit: cloud; ones digit: is the value other than 0?"""
    return _col(cloud).cast("int") * 10 + (_col(value) != 0).cast("int")


def linspace(start: float, stop: float, n: int) -> Column:
    """Array of ``n`` evenly spaced values, both ends included."""
    if n == 1:
        return F.array(F.lit(float(start)))
    step = (stop - start) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(float(start)) + i * F.lit(step))


def permute_axes(df, axes: dict[str, str]):
    """Rename the axis columns of a long table, e.g. ``{'y': 'x', 'x': 'y'}`` to transpose."""
    return df.select(*[F.col(c).alias(axes.get(c, c)) for c in df.columns])
