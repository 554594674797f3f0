"""Annotation documents, feature arrays, example records and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The splits of the image records and the drink records.
SPLITS = ("train", "validation")
DRINK_SPLITS = ("drinks_train", "drinks_test")
# Number of shards of each split.
SHARDS = {"train": 1024, "validation": 128}

ANNOTATION_SCHEMA = """
    images array<struct<id: bigint, file_name: string, width: int, height: int>>,
    annotations array<struct<id: bigint, image_id: bigint, category_id: int, bbox: array<double>>>,
    categories array<struct<id: int, name: string>>
"""


def read_annotations(spark: SparkSession, path, multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, annotations and categories of nested JSON documents.

    ``position`` is the annotation's place in its document. Documents are the
    unit of parallel reading, so a large set should come as many; with
    ``multi_line=False`` each line is a document and files are split.
    """
    docs = spark.read.schema(ANNOTATION_SCHEMA).json(path, multiLine=multi_line)
    images = docs.select(F.explode("images").alias("i")).select(
        F.col("i.id").alias("img_id"), "i.file_name", "i.width", "i.height"
    )
    annotations = docs.select(F.posexplode("annotations").alias("position", "a")).select(
        F.col("a.image_id").alias("img_id"), F.col("a.id").alias("truth_id"), "a.category_id",
        F.struct(*[F.col("a.bbox")[i].alias(n) for i, n in enumerate("xywh")]).alias("bbox"), "position",
    )
    categories = docs.select(F.explode("categories").alias("c")).select("c.id", "c.name").distinct()
    return images, annotations, categories


def label_columns(df: DataFrame, cats) -> DataFrame:
    """Only the label columns of some classes; Parquet reads no others."""
    return df.select(*cats)


def write_features(df: DataFrame, path: str, vec: str = "features", mode: str = "errorifexists") -> None:
    """Feature arrays as Parquet, in single precision."""
    df.withColumn(vec, F.col(vec).cast("array<float>")).write.mode(mode).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def example_records(df: DataFrame) -> DataFrame:
    """Fill the defaults of example records and pack their boxes.

    Missing text becomes '', the format 'jpeg', the label -1; the box arrays
    become one array of (ymin, xmin, ymax, xmax), empty without boxes.
    """
    sides = ("ymin", "xmin", "ymax", "xmax")
    empty = F.array().cast("array<float>")
    arrays = [F.coalesce(F.col(s).cast("array<float>"), empty).alias(s) for s in sides]
    zipped = F.arrays_zip(*arrays)
    return df.select(
        *[c for c in df.columns if c not in (*sides, "encoded", "format", "label", "text", "object_label")],
        F.coalesce("encoded", F.lit("").cast("binary")).alias("encoded"),
        F.coalesce("format", F.lit("jpeg")).alias("format"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("label", F.lit(-1)).cast("int").alias("label"),
        F.transform(zipped, lambda z: F.array(*[z[s] for s in sides])).alias("boxes"),
        F.coalesce("object_label", F.array().cast("array<bigint>")).alias("object_label"),
    )


def write_shards(df: DataFrame, path: str, n: int, prefix: str, key, mode: str = "append") -> None:
    """Spread rows over ``n`` shards named like ``train-00000-of-01024``."""
    keys = [key] if isinstance(key, str) else list(key)
    number = F.pmod(F.xxhash64(*keys), F.lit(n))
    named = df.withColumn("shard", F.format_string(f"{prefix}-%05d-of-{n:05d}", number))
    named.repartition(n, "shard").write.mode(mode).partitionBy("shard").parquet(path)


def read_split(spark: SparkSession, path: str, split: str, splits=SPLITS) -> DataFrame:
    """The shards of one split; an unknown split is an error."""
    if split not in splits:
        raise ValueError(f"unknown split {split!r}, expected one of {', '.join(splits)}")
    return spark.read.option("basePath", path).parquet(f"{path}/shard={split}-*")


def fake_records(spark: SparkSession, n: int, seed: int, width: int = 64) -> DataFrame:
    """Records with uniform values in [-1, 1) and labels 0 to 998."""
    values = F.array(*[F.rand(seed + i) * 2 - 1 for i in range(width)])
    return spark.range(n).select("id", values.alias("values"), F.floor(F.rand(seed - 1) * 999).cast("int").alias("label"))
