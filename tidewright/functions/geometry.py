"""Boxes, grids and image sizes. A box is a struct x, y, w, h."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def box_iou(a, b) -> Column:
    """Intersection over union with inclusive pixel edges; 0 when the boxes are apart."""
    a, b = _col(a), _col(b)

    def overlap(lo, size):
        start = F.greatest(a[lo], b[lo])
        end = F.least(a[lo] + a[size], b[lo] + b[size])
        return F.when(end >= start, end - start + 1).otherwise(F.lit(0.0))

    inter = overlap("x", "w") * overlap("y", "h")
    total = (a["w"] + 1) * (a["h"] + 1) + (b["w"] + 1) * (b["h"] + 1)
    return inter / (total - inter)


def grid_box(box, width, height, side: int = 224, stride: int = 16, cells: int = 13) -> Column:
    """Box on the feature grid: first cell inclusive, last cell exclusive.

    The box is scaled to a square of ``side`` pixels; a pixel belongs to the
    nearest of ``cells`` receptive-field centres, ``stride`` pixels apart.
    """
    box, width, height = _col(box), _col(width), _col(height)

    def nearest(pixel):
        return F.least(F.greatest(F.floor((pixel + 1 + stride / 2) / float(stride)), F.lit(1)), F.lit(cells))

    def axis(lo, size, extent):
        first = nearest(F.floor(box[lo] * side / extent)) - 1
        last = nearest(F.ceil((box[lo] + box[size]) * side / extent))
        return first.cast("int"), last.cast("int")

    x0, x1 = axis("x", "w", width)
    y0, y1 = axis("y", "h", height)
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def lonlat_cell(lon, lat, west, north, east, south, cells: float = 100.0) -> Column:
    """Raster cell of a place: x counts from the west edge, y from the south edge."""
    lon, lat, west, north, east, south = map(_col, (lon, lat, west, north, east, south))
    x = F.lit(100.0) - (lon - east) / (west - east) * cells
    y = (lat - south) / (north - south) * cells
    return F.struct(x.alias("x"), y.alias("y"))


def shortest_side(height, width, side: int) -> Column:
    """Size with the shorter side equal to ``side``, same aspect, cut to whole pixels."""
    height, width = _col(height).cast("double"), _col(width).cast("double")
    scale = F.lit(float(side)) / F.least(height, width)
    return F.struct(
        (height * scale).cast("int").alias("height"), (width * scale).cast("int").alias("width")
    )


def central_bounds(extent, fraction: float | None = None, size: int | None = None) -> Column:
    """First cell (inclusive) and last cell (exclusive) of a central crop along one axis."""
    extent = _col(extent)
    if size is None:
        first = F.floor((extent - extent * fraction) / 2)
        last = extent - first
    else:
        first = F.floor((extent - size) / 2)
        last = first + size
    return F.struct(first.cast("long").alias("first"), last.cast("long").alias("last"))


def pack_boxes(ymin, xmin, ymax, xmax) -> Column:
    """Four coordinate arrays to one array of [ymin, xmin, ymax, xmax]."""
    zipped = F.arrays_zip(
        _col(ymin).alias("a"), _col(xmin).alias("b"), _col(ymax).alias("c"), _col(xmax).alias("d")
    )
    return F.transform(zipped, lambda z: F.array(z["a"], z["b"], z["c"], z["d"]))
