"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.session import scratch_path

#: Words as runs of anything but ASCII white space.
BLANK = r"[\x20\x09-\x0D]+"
#: Spark's switch that removes shuffle files at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once below the shared checkpoint folder and read it from there.

    The files are complete before anything reads them, so a lost executor
    costs no recomputation of what came before, and the shuffle files of the write go as soon as it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have: the name with as many leading underscores as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null is empty."""
    return [b"" if v is None else v for v in column.cast("binary").to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut to fewer rows, so that Python objects of few texts live at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def empty_if_null(name: str):
    return F.coalesce(F.col(name), F.lit(""))


#: Letters of Latin-1, in composed form, then ASCII marks.
WORD_AND_MARKS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")


_HELD: dict = {}


def claim(operator: str, forget) -> None:
    """Say that a worker now works for an operator: what others have remembered in it is forgotten."""
    for other in [name for name in _HELD if name != operator]:
        _HELD.pop(other)()
    _HELD[operator] = forget


class Remembered(dict):
    """A dict that finds missing values with ``find`` and keeps at most two generations of ``limit`` entries."""

    def __init__(self, find, limit: int):
        super().__init__()
        self.find, self.limit, self.old = find, limit, {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, key):
        if key in self.old:
            found = self.old[key]
        else:
            found = self.find(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found
