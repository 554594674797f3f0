"""Image files to labelled images: path parts, quality test, join with the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.text import folder_up
from tidewright.functions.times import compact_date
from tidewright.operators.joins import inner_on
from tidewright.operators.select import good_images, to_numeric


def image_facts(files: DataFrame, path: str = "img_path") -> DataFrame:
    """Pad number (folder of the file) and week (third folder above that) of each image path."""
    return to_numeric(files.withColumn("pad_number", folder_up(path, 1)), ["pad_number"]).withColumn(
        "week_of", compact_date(folder_up(path, 3))
    )


def labelled_images(files: DataFrame, pixels: DataFrame, labels: DataFrame) -> DataFrame:
    """Good images with the label of their pad and week; rows with a gap are left out."""
    good = good_images(pixels, "img_path").select("img_path")
    facts = image_facts(files.join(good, "img_path"))
    return inner_on(facts, labels.withColumn("pad_number", F.col("pad_number").cast("double")), ["pad_number", "week_of"], complete=True)
