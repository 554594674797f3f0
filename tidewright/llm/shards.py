"""Shards of a random order by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets of bounded bytes by a seeded
hash of the whole row, so copies of one text or of one id spread as well. Pass two
puts each bucket in a fixed order and Fisher-Yates shuffles it in memory. A
bucket's start among all records is the number of records in the buckets before
it, so a record's place in the whole order is known without a global sort, and
shards are equal stretches of that order: their counts differ by one at most.

The records move once. Only column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.order import prefix_sums
from tidewright.session import scratch_path

#: Bytes of text per bucket; a bucket is held in memory by one task.
BUCKET_BYTES = 8 << 20


def size_of(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")


def write_shards(
    docs: DataFrame, path: str, shards: int, seed: int = 17, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write all rows and columns as Parquet under ``shard=<n>`` folders, with ``slot``, the place in the shard.

    Law: counts of shards differ by one at most, slots are gapless from 0, and the order is random but for the seed. Null
    texts, ties and repeated rows are records like any other (rows that are equal in every column share a bucket). An
    empty table writes an empty table. Columns named shard and slot are replaced.
    """
    base = docs.drop("shard", "slot")
    total, size = base.agg(F.count("*"), F.coalesce(F.sum(size_of(text_col)), F.lit(0))).first()
    buckets = max(1, -(-size // bucket_bytes))
    row = F.struct(*base.columns)
    scattered = base.select(F.pmod(F.xxhash64(F.lit(seed), *base.columns), F.lit(buckets)).alias("_bucket"), row.alias("_row"))
    counts = scattered.groupBy("_bucket").agg(F.count("*").alias("_n"))
    starts = prefix_sums(counts, "_bucket", {"_upto": "_n"}).select("_bucket", (F.col("_upto") - F.col("_n")).alias("_start"))
    filled = scattered.groupBy("_bucket").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    shuffled = (
        filled.join(starts, "_bucket")
        .sortWithinPartitions("_bucket")
        .select("_start", F.shuffle("_rows", seed).alias("_rows"))
        .select("_start", F.posexplode("_rows").alias("_place", "_row"))
        .withColumn("_at", F.col("_start") + F.col("_place"))
    )
    placed = shuffled.withColumn("shard", F.expr(f"CAST((_at * {shards}L) DIV {max(total, 1)}L AS INT)"))
    first = F.expr(f"(CAST(shard AS BIGINT) * {total}L + {shards - 1}L) DIV {shards}L")
    out = placed.select("_row.*", "shard", (F.col("_at") - first).alias("slot"))
    out.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What ``write_shards`` wrote for the frame ``like``."""
    schema = like.drop("shard", "slot").withColumns({"slot": F.lit(None).cast("long"), "shard": F.lit(None).cast("int")}).schema
    return spark.read.schema(schema).parquet(path)


def reshard(docs: DataFrame, shards: int, seed: int = 17, text_col: str = "text") -> DataFrame:
    """Write shards below the shared checkpoint folder and read them."""
    path = scratch_path(docs.sparkSession, "shards")
    write_shards(docs, path, shards, seed, text_col)
    return read_shards(docs.sparkSession, path, docs)
