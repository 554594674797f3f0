"""Click log to features: time parts, nine counts and the time to the next click."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.keys import bucket_of
from tidewright.functions.text import join_key
from tidewright.functions.times import epoch_seconds
from tidewright.operators.counts import click_counts
from tidewright.operators.sequence import next_gap
from tidewright.sources.text_files import CLICK_SCHEMA, scan_csv, write_csv

NEXT_CLICK_KEY = ("ip", "app", "device", "os")
# Fixed value: number of categories a click key is hashed to.
CATEGORIES = 2**26


def click_features(clicks: DataFrame, id: str = "click_id") -> DataFrame:
    """All features of a click table that has a row id.

    The gap is by the exact key; ``category`` is only a number for the key.
    """
    gaps = next_gap(clicks, NEXT_CLICK_KEY, "click_time", id, name="next_click")
    named = gaps.withColumns({
        "category": bucket_of(CATEGORIES, 0, join_key(*NEXT_CLICK_KEY)),
        "epochtime": epoch_seconds(F.col("click_time")),
    })
    return click_counts(named)


def click_feature_file(spark: SparkSession, source: str, target: str, schema=CLICK_SCHEMA, id: str | None = None) -> None:
    """CSV in, CSV with features out. Without a row id, place within a file decides ties."""
    clicks = scan_csv(spark, source, schema)
    if id is None:
        clicks, id = clicks.withColumn("click_id", F.monotonically_increasing_id()), "click_id"
    write_csv(click_features(clicks, id), target, 5)
