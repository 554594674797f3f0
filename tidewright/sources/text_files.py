"""CSV in and out, file discovery and run markers."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types of the click log; Spark has no unsigned types.
CLICK_SCHEMA = T.StructType([
    T.StructField("ip", T.LongType()),
    T.StructField("app", T.IntegerType()),
    T.StructField("device", T.IntegerType()),
    T.StructField("os", T.IntegerType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("click_time", T.TimestampType()),
    T.StructField("is_attributed", T.ShortType()),
])


def scan_csv(spark: SparkSession, path, schema: T.StructType, cols=None) -> DataFrame:
    """Typed scan; only the chosen columns are parsed."""
    df = spark.read.csv(path, schema=schema, header=True)
    return df.select(*cols) if cols else df


def fixed_decimals(df: DataFrame, decimals: int) -> DataFrame:
    """Floating columns as text with a fixed number of decimals."""
    return df.select(*[
        F.format_string(f"%.{decimals}f", F.col(n).cast("double")).alias(n) if t in ("float", "double") else F.col(n)
        for n, t in df.dtypes
    ])


def write_csv(df: DataFrame, path: str, decimals: int, mode: str = "errorifexists") -> None:
    """CSV with a header; times keep their microseconds."""
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    fixed_decimals(df, decimals).write.mode(mode).options(timestampFormat=pattern, timestampNTZFormat=pattern).csv(path, header=True)


def submission(df: DataFrame, id: str, score: str) -> DataFrame:
    return df.select(F.col(id).cast("int").alias("id"), F.col(score).alias("target"))


def without_scheme(path) -> Column:
    """A local path without ``file:``; paths of other stores stay as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def plain_path(uri) -> Column:
    """The path of a row's file, whose URI is escaped."""
    return F.url_decode(F.replace(without_scheme(uri), F.lit("+"), F.lit("%2B")))


def discover(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """All files below ``root`` whose name fits ``pattern``; contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    )
    return found.select(without_scheme(F.col("path")).alias("path"), "modificationTime", "length")


def discover_many(spark: SparkSession, root: str, patterns=("*.csv", "*.xlsx"), keep=None) -> DataFrame:
    """Files that fit any pattern and a filter on the path column (all pass by default)."""
    frames = [discover(spark, root, p) for p in patterns]
    found = reduce(lambda a, b: a.unionByName(b), frames).dropDuplicates(["path"])
    return found.filter(keep(F.col("path"))) if keep else found


def mark_done(spark: SparkSession, path: str, **params) -> str:
    """Write a marker with content 1, named by the parameters and the time."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    name = "_".join([*(f"{k}-{v}" for k, v in sorted(params.items())), stamp])
    spark.range(1).select(F.lit("1").alias("value")).coalesce(1).write.text(f"{path}/{name}")
    return f"{path}/{name}"
