"""Column choice by name, row filters and samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.keys import bucket_of, hash_unit, match_on, md5_number, value_key
from tidewright.functions.text import non_blank_text
from tidewright.functions.vectors import argmax_position
from tidewright.operators.order import _as_list

# The 18 detection classes and the background class.
DETECTION_CLASSES = (
    "bear", "bird", "cat", "cow", "dog", "elephant", "giraffe", "horse", "sheep", "zebra",
    "airplane", "bicycle", "boat", "bus", "car", "motorcycle", "train", "truck", "background",
)
# Fixed value: first day of a raster request.
SERIES_START = datetime(2017, 1, 1)


def cols_like(df: DataFrame, infix: str = "", suffix: str = "", not_suffix: str | None = None) -> list[str]:
    """Columns whose name contains ``infix``, ends in ``suffix`` and not in ``not_suffix``."""
    return [
        c for c in df.columns
        if infix in c and c.endswith(suffix) and not (not_suffix and c.endswith(not_suffix))
    ]


def predictors(df: DataFrame, exclude) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def column_roles(df: DataFrame) -> dict[str, list[str]]:
    """Columns by the last part of their name: ``cat``, ``bin``, others numeric."""
    roles: dict[str, list[str]] = {"numeric": [], "categorical": [], "binary": []}
    kinds = {"cat": "categorical", "bin": "binary"}
    for c in df.columns:
        roles[kinds.get(c.rsplit("_", 1)[-1], "numeric")].append(c)
    return roles


def add_products(df: DataFrame, products: dict[str, list[str]]) -> DataFrame:
    """New columns as products; a column listed twice is squared."""
    def times(cols):
        out = F.col(cols[0])
        for c in cols[1:]:
            out = out * F.col(c)
        return out

    return df.withColumns({name: times(cols) for name, cols in products.items()})


def drop_cols(df: DataFrame, cols) -> DataFrame:
    return df.drop(*cols)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def to_numeric(df: DataFrame, cols) -> DataFrame:
    """Text to double; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def good_images(
    px: DataFrame, image: str = "img_id", value: str = "value",
    hi: float = 200, hi_share: float = 0.8, lo: float = 50, lo_share: float = 0.4,
) -> DataFrame:
    """Images that are neither too bright nor too dark; an image without readable pixels is left out."""
    shares = px.filter(F.col(value).isNotNull()).groupBy(image).agg(
        F.avg((F.col(value) > hi).cast("double")).alias("bright"),
        F.avg((F.col(value) < lo).cast("double")).alias("dark"),
    )
    return shares.filter((F.col("bright") <= hi_share) & (F.col("dark") <= lo_share))


def good_image_arrays(df: DataFrame, values: str, hi=200, hi_share=0.8, lo=50, lo_share=0.4) -> DataFrame:
    """The same test on one array of pixels per row, without a shuffle."""
    def share(test):
        return F.size(F.filter(F.col(values), test)) / F.size(values)

    readable = F.col(values).isNotNull() & (F.size(values) > 0)
    return df.filter(readable & (share(lambda v: v > hi) <= hi_share) & (share(lambda v: v < lo) <= lo_share))


def valid_coords(df: DataFrame, lon: str, lat: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a place on the globe, and the rejected rest (nulls included)."""
    ok = F.coalesce((F.abs(lon) <= 180) & (F.abs(lat) <= 90), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def clip(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.least(F.greatest(F.col(col), F.lit(lo)), F.lit(hi))))


def expm1_clip(df: DataFrame, col: str) -> DataFrame:
    """``exp(p) - 1`` within 0 and 1."""
    return clip(df.withColumn(col, F.exp(col) - 1.0), col, 0.0, 1.0)


def sample_fraction(df: DataFrame, frac: float, key, seed: int) -> DataFrame:
    """A share of the rows, fixed by key and seed."""
    return df.filter(hash_unit(seed, *_as_list(key)) < frac)


def sample_n(df: DataFrame, n: int, by, key, seed: int, cell_rows: int = 50_000) -> DataFrame:
    """``n`` rows of each group without replacement (all when it has fewer).

    The rows with the smallest hash are taken. Counts of rows per hash cell
    show in which cell the n-th row falls: lower cells are taken whole and only
    that one cell is ranked. Cells are as many as make about ``cell_rows`` of the
    largest group fall into one, so no group is ever sorted in one task.
    """
    by, keys = _as_list(by), _as_list(key)
    largest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    cells = min(1 << 24, max(1, -(-largest // cell_rows)))
    hashed = df.withColumn("_h", md5_number(value_key(seed, *keys))).withColumn(
        "_cell", F.floor(F.col("_h") * cells / (1 << 32))
    )
    sizes = hashed.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        sizes.withColumn("_need", n - F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .filter(F.col("_need") > 0)
    )
    joined = match_on(hashed, quota, [*by, "_cell"])
    whole = joined.filter(F.col("_n") <= F.col("_need"))
    rank = F.row_number().over(Window.partitionBy(*by, "_cell").orderBy("_h", *keys))
    part = joined.filter(F.col("_n") > F.col("_need")).withColumn("_rank", rank)
    return whole.select(*df.columns).unionByName(part.filter(F.col("_rank") <= F.col("_need")).select(*df.columns))


def thin_candidates(df: DataFrame, keep: float, seed: int, key=None) -> DataFrame:
    """Keep each candidate with probability ``keep``."""
    draw = F.rand(seed) if key is None else hash_unit(seed, *_as_list(key))
    return df.filter(draw <= keep)


def non_blank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(non_blank_text(col))


def only_table(df: DataFrame, name: str | None = None, col: str = "destination_table") -> DataFrame:
    """Rows of one destination table, or all rows without a name."""
    return df.filter(F.col(col) == name) if name else df


def whitelist(df: DataFrame, col: str, values=DETECTION_CLASSES) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def argmax_index(df: DataFrame, array_col: str, name: str = "class_index") -> DataFrame:
    return df.withColumn(name, argmax_position(array_col))


def label_positions(df: DataFrame, array_col: str, positive: bool = True) -> DataFrame:
    """One row for each (row, class) whose label is above 0, or equal to 0."""
    others = [c for c in df.columns if c != array_col]
    spread = df.select(*others, F.posexplode(array_col).alias("class_index", "_label"))
    return spread.filter(F.col("_label") > 0 if positive else F.col("_label") == 0).drop("_label")


def series_range(
    df: DataFrame, ts: str, start, end, max_cloud: float, cloud: str = "cloud", series: str = "series_id"
) -> DataFrame:
    """Observations in a time range whose cloud share does not exceed ``max_cloud``."""
    inside = df.filter(F.col(ts).between(F.lit(start), F.lit(end)))
    shares = inside.groupBy(series, ts).agg(F.avg(F.col(cloud).cast("double")).alias("_share"))
    clear = shares.filter(F.col("_share") <= max_cloud)
    return inside.join(clear.select(series, ts), [series, ts], "left_semi")


def assign_bucket(df: DataFrame, buckets: int, seed: int, key, name: str = "bucket") -> DataFrame:
    return df.withColumn(name, bucket_of(buckets, seed, *_as_list(key)))
