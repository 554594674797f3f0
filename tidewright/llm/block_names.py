"""Exact duplicates by deterministic block naming.

Every text, with A-Z in lower case, is cut into blocks of a fixed number of bytes (the last is shorter; an empty text has one
empty block). All blocks are sorted, and a block's name is its rank among the distinct ones, so two blocks have one name
exactly if they are equal. Adjacent names of a text are then paired, an odd last one stands alone, and the pairs are sorted
and named again, until each text has one name. Two texts are equal exactly if they end on the same level with the same
name; no hash decides anything.

The sort is by range over (block, row, place): a block that a third of all rows share spreads over as many tasks as it
fills, and the rank goes on from one task to the next by the first and last block of each task. The bytes of the texts move
once; later levels move pairs of integers, half as many on each level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tidewright.llm.common import free_name, slices, store, text_bytes

#: Bytes of a block.
BLOCK = 2048
#: A class that holds at least this share of all rows (one in ``LARGE``) is large.
LARGE = 2000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """row, pos, n (blocks of the text), key (the block); id and the digest of the text on the first block."""
    schema = StructType([
        StructField("row", LongType()), StructField("pos", LongType()), StructField("n", LongType()), StructField("id", rows.schema["id"].dataType),
        StructField("digest", BinaryType()), StructField("key", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, pos, of, sizes, digests = [], [], [], [], []
            for i, text in enumerate(text_bytes(batch.column("text"))):
                low = text.translate(_LOWER)
                n = max(1, -(-len(low) // block))
                keys += [low[k * block: (k + 1) * block] for k in range(n)]
                pos += range(n)
                of += [i] * n
                sizes += [n] * n
                digests += [hashlib.sha256(low).digest(), *[None] * (n - 1)]
            first = pa.array([i if p == 0 else None for i, p in zip(of, pos)], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("row").take(pa.array(of, pa.int64())), pa.array(pos, pa.int64()), pa.array(sizes, pa.int64()), batch.column("id").take(first),
                pa.array(digests, pa.binary()), pa.array(keys, pa.binary()),
            ], names=schema.names)

    return rows.select("row", "id", "text").mapInArrow(run, schema)


def _named(nodes: DataFrame) -> DataFrame:
    """nodes(row, pos, n, id, digest, key) with ``name``, the 0-based rank of the key among distinct keys, for the key."""
    kept = ["row", "pos", "n", "id", "digest"]
    schema = StructType([*[nodes.schema[c] for c in kept], StructField("part", IntegerType()), StructField("place", LongType()),
                         StructField("first", BinaryType()), StructField("last", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last, place = TaskContext.get().partitionId(), None, None, 0
        none = pa.nulls
        batch = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key")
            head = key[0].as_py()
            steps = pc.not_equal(key[1:], key[:-1]).cast("int64")
            if first is None:
                first = head
            elif head != last:
                place += 1
            places = pc.add(pc.cumulative_sum(pa.concat_arrays([pa.array([0], pa.int64()), steps])), place)
            place, last, size = places[-1].as_py(), key[-1].as_py(), batch.num_rows
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in kept], pa.array([part] * size, pa.int32()), places, none(size, pa.binary()), none(size, pa.binary()),
            ], names=schema.names)
        if first is not None:  # a closing row: the first and the last key of the task, and how many it has
            yield pa.RecordBatch.from_arrays([
                *[none(1, batch.column(c).type) for c in kept], pa.array([part], pa.int32()), pa.array([place + 1], pa.int64()),
                pa.array([first], pa.binary()), pa.array([last], pa.binary()),
            ], names=schema.names)

    by = ["key", "row", "pos"]
    placed = store(nodes.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), "names")
    # One closing row per task. A task that goes on with the last key of the one before shares that key's name.
    tasks = Window.orderBy("part")
    shared = F.coalesce((F.col("first") == F.lag("last").over(tasks)).cast("long"), F.lit(0))
    closing = placed.where("first IS NOT NULL").select("part", "place", shared.alias("shared"))
    start = F.sum(F.col("place") - F.col("shared")).over(tasks) - F.col("place")
    starts = F.broadcast(closing.select("part", start.alias("start")))
    return placed.where("first IS NULL").join(starts, "part").select(*kept, (F.col("start") + F.col("place")).alias("name"))


def _paired(nodes: DataFrame) -> DataFrame:
    """The next level: adjacent names of a text as one key of two 8-byte numbers, 0 for a missing right one."""
    even = F.col("pos") % 2 == 0
    pairs = nodes.groupBy("row", F.floor(F.col("pos") / 2).alias("pos")).agg(
        F.ceil(F.max("n") / 2).alias("n"), F.max("id").alias("id"), F.max("digest").alias("digest"),
        F.max(F.when(even, F.col("name"))).alias("left"), F.max(F.when(~even, F.col("name") + 1)).alias("right"),
    )
    half = [F.lpad(F.hex(c), 16, "0") for c in (F.col("left"), F.coalesce("right", F.lit(0)))]
    return pairs.select("row", "pos", "n", "id", "digest", F.unhex(F.concat(*half)).alias("key"))


def identities(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """row, id, digest (sha256 of the text), level, name for each row of rows(row, id, text): the text's collision-free identity.

    ``row`` is unique, and the same at every read. A null text counts as empty.
    """
    named = _named(_blocks(rows, block))
    most = named.agg(F.max("n")).first()[0] or 1
    done, level = [], 0
    while True:
        done.append(named.where("n = 1").select("row", "id", "digest", F.lit(level).alias("level"), "name"))
        if most <= 1:
            break
        named, most, level = _named(_paired(named.where("n > 1"))), -(-most // 2), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def classes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """row, id, keep_id, group_size, kept, digest for each row of rows(row, id, text), as ``identities`` takes it.

    Of equal texts the row with the largest id stays (a null id is the smallest; of equal ids the one with the largest row).
    Counts and maxima combine before the shuffle. Rows of large classes, of which there are ``LARGE`` at most, get
    their class's figures by a broadcast and are not shuffled by class.
    """
    found, by = identities(rows, block), ["level", "name"]
    best = store(found.groupBy(*by).agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size")), "classes")
    total = best.agg(F.sum("group_size")).first()[0] or 0
    is_large = F.col("group_size") * LARGE >= F.lit(total)
    large = best.where(is_large)
    told = found.join(F.broadcast(large), by).unionByName(found.join(F.broadcast(large.select(*by)), by, "left_anti").join(best.where(~is_large), by))
    return told.select(
        "row", "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"), "digest",
    )


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256 for each row of a table that gives its rows in the same order at every read.

    Null and empty texts are one class, a repeated row or id is a row like any other, an empty table has no rows, and further
    columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return classes(rows, block).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows that stay, with all their columns. Any frame will do: it is written once, with its row numbers."""
    number = free_name(docs, "row")
    numbered = store(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col(number).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    stay = classes(rows, block).where("kept").select(F.col("row").alias(number))
    return numbered.join(stay, number, "left_semi").drop(number)
