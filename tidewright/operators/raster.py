"""Neighbourhood maxima, pyramid pooling and averages over gridded values in long form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.geometry import grid_box

#: Grid values that are pooled at a time in a worker.
POOL_VALUES = 1 << 20


def grid_cells(df: DataFrame, vec: str, width: int, keep) -> DataFrame:
    """An array of ``width * width`` values as long cells ``(x, y, value)``, row by row."""
    return df.select(*keep, F.posexplode(vec).alias("_p", "value")).select(
        *keep, (F.col("_p") % width).cast("int").alias("x"), F.floor(F.col("_p") / width).cast("int").alias("y"), "value"
    )


def max_around(cells: DataFrame, y: int, x: int, radius: int = 1, by=("series_id",)) -> DataFrame:
    """Greatest value within ``radius`` cells of one place, for each group."""
    near = F.col("y").between(y - radius, y + radius) & F.col("x").between(x - radius, x + radius)
    return cells.filter(near).groupBy(*by).agg(F.max("value").alias("value"))


def max_filter(cells: DataFrame, radius: int = 1, by=("series_id",)) -> DataFrame:
    """The same maximum around every cell: each value is offered to the cells it reaches."""
    steps = [F.lit(d) for d in range(-radius, radius + 1)]
    reach = cells.select(
        *by, "x", "y", "value", F.explode(F.array(*steps)).alias("_dx")
    ).select("*", F.explode(F.array(*steps)).alias("_dy"))
    pooled = reach.groupBy(*by, (F.col("x") + F.col("_dx")).alias("x"), (F.col("y") + F.col("_dy")).alias("y")).agg(
        F.max("value").alias("value"), F.max((F.col("_dx") == 0) & (F.col("_dy") == 0)).alias("_own")
    )
    return pooled.filter("_own").drop("_own")


def global_avg(cells: DataFrame, by=("img_id", "channel")) -> DataFrame:
    return cells.groupBy(*by).agg(F.avg(F.col("value").cast("double")).alias("value"))


def central_crop(cells: DataFrame, extent: int, fraction: float) -> DataFrame:
    """Cells of the central part of a square grid."""
    first = int((extent - extent * fraction) // 2)
    inside = [F.col(a).between(first, extent - first - 1) for a in ("x", "y")]
    return cells.filter(inside[0] & inside[1])


def _bins(lo: np.ndarray, hi: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of each of ``n`` bins, by bin and row."""
    i = np.arange(n)[:, None]
    return lo + i * (hi - lo) // n, lo - -(i + 1) * (hi - lo) // n


def max_pools(grid: np.ndarray, x0, y0, x1, y1, sizes) -> list[np.ndarray]:
    """Largest value of each bin, ``n * n`` by row for each size; ``grid`` is by x, y and row, NaN counts as largest."""
    side, _, rows = grid.shape
    place = np.arange(side)[:, None]
    least = -np.inf if grid.dtype.kind == "f" else np.iinfo(grid.dtype).min
    out = []
    for n in sizes:
        x_first, x_last = _bins(x0, x1, n)
        y_first, y_last = _bins(y0, y1, n)
        pooled = np.empty((n, n, rows), grid.dtype)
        for j in range(n):
            columns = np.where((place >= y_first[j]) & (place < y_last[j]), grid, least).max(1)
            for i in range(n):
                pooled[i, j] = np.where((place >= x_first[i]) & (place < x_last[i]), columns, least).max(0)
        out.append(pooled.reshape(n * n, rows).T.astype(grid.dtype))
    return out


#: Types of grid values that are pooled in a worker.
NUMBERS = ("float", "double", "int", "bigint", "smallint", "tinyint")


def _pools(values: pa.Array, side: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, sizes) -> pa.Array:
    """A struct of pools for each row, null without values or with a null among them."""
    given = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    flat = values.flatten()
    sides, *edges = (c.take(pa.array(given)).to_numpy(zero_copy_only=False).astype(np.int64) for c in (side, x0, y0, x1, y1))
    ends = np.cumsum(sides * sides)
    whole = np.ones(len(given), bool)
    if flat.null_count:
        gaps = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
        whole = gaps[ends] == gaps[ends - sides * sides]
    numbers = flat.fill_null(0).to_numpy(zero_copy_only=False)
    pools = [np.zeros((len(values), n * n), numbers.dtype) for n in sizes]
    for width in np.unique(sides[whole]):
        at = np.flatnonzero(whole & (sides == width))
        step = max(1, POOL_VALUES // int(width * width))
        for part in (at[k: k + step] for k in range(0, len(at), step)):
            places = (ends[part] - width * width) + np.arange(width * width)[:, None]
            grid = numbers[places].reshape(width, width, len(part))
            for pool, found in zip(pools, max_pools(grid, *(e[part] for e in edges), sizes)):
                pool[given[part]] = found
    missing = np.ones(len(values), bool)
    missing[given[whole]] = False
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * n * n, pa.int32()), pa.array(p.ravel())) for n, p in zip(sizes, pools)]
    return pa.StructArray.from_arrays(lists, names=[f"pool_{n}" for n in sizes], mask=pa.array(missing))


def _pool_type(kind: str, sizes) -> str:
    return f"struct<{', '.join(f'pool_{n}: array<{kind}>' for n in sizes)}>"


def _pooler(kind: str, sizes):
    """Function of the columns values, side, x0, y0, x1, y1: a struct of pools, null without values or with a null among them."""
    def run(values: pa.Array, side: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        return _pools(values, side, x0, y0, x1, y1, sizes)

    return F.arrow_udf(run, _pool_type(kind, sizes))


def _list_pooler(kind: str, sizes):
    """The same for an array of structs of these six."""
    def run(items: pa.Array) -> pa.Array:
        ends = items.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), _pools(*items.flatten().flatten(), sizes))

    return F.arrow_udf(run, f"array<{_pool_type(kind, sizes)}>")


def _whole(values, side, g):
    """The values, where they are a square grid that holds the box; else null."""
    inside = (g["x0"] >= 0) & (g["x0"] < g["x1"]) & (g["x1"] <= side) & (g["y0"] >= 0) & (g["y0"] < g["y1"]) & (g["y1"] <= side)
    return F.when(inside & (F.size(values) == side.cast("long") * side), values)


def _plain_pools(values, side, g, sizes) -> list:
    """The pools of one row as an expression, for any values and any box."""
    def edges(i, n, lo, hi):
        length = hi - lo
        first = lo + F.floor(F.lit(i) * length / n)
        last = lo + F.ceil(F.lit(i + 1) * length / n)
        return first, last

    def bin_max(i, j, n):
        x_first, x_last = edges(i, n, g["x0"], g["x1"])
        y_first, y_last = edges(j, n, g["y0"], g["y1"])
        columns = F.transform(
            F.sequence(x_first, x_last - 1),
            lambda x: F.array_max(F.slice(values, (x * side + y_first + 1).cast("int"), (y_last - y_first).cast("int"))),
        )
        return F.array_max(columns)

    return [F.array(*[bin_max(i, j, n) for i in range(n) for j in range(n)]) for n in sizes]


def pyramid_pool(grids: DataFrame, boxes: DataFrame, sizes=(1, 3, 6), image: str = "img_id", columns: bool = True) -> DataFrame:
    """Largest value in each bin of a box crop, for pyramids of ``sizes`` bins per axis.

    ``grids`` has one row per image and channel with ``values``, the cells of
    the grid column by column (x outer, y inner) and the grid's ``side``;
    ``boxes`` has ``box_id`` and ``grid`` (x0, y0, x1, y1). A bin i of n over
    length m covers floor(i m / n) .. ceil((i + 1) m / n). A grid is a short
    array, so pooling is per (box, channel) and the only shuffle is the join of
    boxes with their image. Boxes inside whole square grids of numbers are pooled
    by columns of many boxes, any other row (without ``columns`` each) by an expression of its own.
    """
    joined = boxes.join(grids, image)
    g = F.col("grid")
    pooled = _plain_pools(F.col("values"), F.col("side"), g, sizes)
    kind = joined.schema["values"].dataType.elementType.simpleString()
    if columns and kind in NUMBERS:
        joined = joined.withColumn("_pools", _pooler(kind, sizes)(_whole(F.col("values"), F.col("side"), g), "side", g["x0"], g["y0"], g["x1"], g["y1"]))
        pooled = [F.when(F.col("_pools").isNull(), p).otherwise(F.col(f"_pools.pool_{n}")) for p, n in zip(pooled, sizes)]
    return joined.select(image, "box_id", "channel", *[p.alias(f"pool_{n}") for p, n in zip(pooled, sizes)])


def _box_pools(grids: DataFrame, boxes: DataFrame, sizes, image: str) -> DataFrame:
    """The rows of ``pyramid_pool`` as one array ``_c`` for each (image, box): ``image, box_id, _c`` with structs of channel and pools.

    Boxes and the channels of an image are gathered before they meet, so pools are made where they are used and never sent.
    """
    placed = boxes.groupBy(image, "box_id").agg(F.collect_list(F.struct("grid")).alias("_b"))
    shown = grids.groupBy(image).agg(F.collect_list(F.struct("channel", "values", "side")).alias("_g"))
    edges = ("x0", "y0", "x1", "y1")
    # Each box at each channel; in a column of its own, as it is read twice.
    items = F.flatten(F.transform("_b", lambda b: F.transform("_g", lambda c: F.struct(
        c["channel"].alias("channel"), c["values"].alias("values"), c["side"].alias("side"), b["grid"].alias("grid")))))
    joined = placed.join(shown, image).select(image, "box_id", items.alias("_items"))
    kind = grids.schema["values"].dataType.elementType.simpleString()

    def plain(item):
        return _plain_pools(item["values"], item["side"], item["grid"], sizes)

    if kind not in NUMBERS:
        pooled = F.transform("_items", lambda i: F.struct(i["channel"].alias("channel"), *[p.alias(f"pool_{n}") for p, n in zip(plain(i), sizes)]))
        return joined.select(image, "box_id", pooled.alias("_c"))
    asked = F.transform("_items", lambda i: F.struct(
        _whole(i["values"], i["side"], i["grid"]).alias("values"), i["side"].alias("side"), *[i["grid"][e].alias(e) for e in edges]))
    joined = joined.withColumn("_pools", _list_pooler(kind, sizes)(asked))

    def one(item, pools):
        return F.struct(item["channel"].alias("channel"), *[
            F.when(pools.isNull(), p).otherwise(pools[f"pool_{n}"]).alias(f"pool_{n}") for p, n in zip(plain(item), sizes)])

    return joined.select(image, "box_id", F.zip_with("_items", "_pools", one).alias("_c"))


def box_features(grids: DataFrame, boxes: DataFrame, images: DataFrame, sizes=(1, 3, 6), cells: int = 13,
                 side: int = 224, stride: int = 16, image: str = "img_id") -> DataFrame:
    """Pooled feature array of every box; an image without boxes gives no row.

    The array lists the channels of the first pyramid, then of the next.
    """
    placed = boxes.join(images.select(image, "width", "height"), image).select(
        image, "box_id", grid_box("bbox", "width", "height", side, stride, cells).alias("grid")
    )
    per_box = _box_pools(grids, placed, sizes, image).withColumn("_c", F.sort_array("_c"))  # one short struct per channel
    return per_box.select(
        image, "box_id", F.concat(*[F.flatten(F.col(f"_c.pool_{n}")) for n in sizes]).alias("features")
    )
