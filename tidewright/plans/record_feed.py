"""Record shards to training batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.keys import value_key
from tidewright.operators.order import batches
from tidewright.sources.records import example_records, read_split


def record_batches(spark: SparkSession, path: str, split: str, batch_size: int, key: str, seed: int = 0, epoch: int = 0) -> DataFrame:
    """One epoch of a split: defaults filled, order drawn anew for the epoch, full batches only."""
    records = example_records(read_split(spark, path, split))
    mixed = records.withColumn("_h", F.md5(value_key(f"{seed}-{epoch}", key)))
    return batches(mixed, batch_size, ["_h", key]).drop("_h")
