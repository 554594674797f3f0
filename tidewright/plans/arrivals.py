"""Raster series to the first arrival of water at some places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.geometry import lonlat_cell
from tidewright.operators.sequence import first_arrival


def water_arrivals(cells: DataFrame, clouds: DataFrame, targets: DataFrame) -> DataFrame:
    """First arrival per target.

    ``cells`` and ``clouds`` are long rasters ``(ts, y, x, value | cloud)``,
    ``targets`` has target_id, lon, lat and the corners west, north, east, south.
    A target sees the greatest value of the 3 x 3 cells around it, so each
    target is sent to its nine cells and the rasters are only filtered.
    """
    placed = targets.select("target_id", lonlat_cell("lon", "lat", "west", "north", "east", "south").alias("p")).select(
        "target_id", F.col("p.x").cast("int").alias("x"), F.col("p.y").cast("int").alias("y")
    )
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    around = placed.select("target_id", F.explode(step).alias("dx"), "x", "y").select(
        "target_id", (F.col("x") + F.col("dx")).alias("x"), F.explode(step).alias("dy"), "y"
    ).select("target_id", "x", (F.col("y") + F.col("dy")).alias("y"))
    water = cells.join(around, ["y", "x"]).groupBy("target_id", "ts").agg(F.max("value").alias("value"))
    cloud = clouds.join(placed, ["y", "x"]).select("target_id", "ts", "cloud")
    return first_arrival(water.join(cloud, ["target_id", "ts"]), "target_id", "ts", "cloud", "value")
