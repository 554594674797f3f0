"""Near neighbours by random-projection hashing.

Queries and indexed vectors of a bucket (table, key) meet in one task, which
multiplies their matrices and hands on the few nearest of each query, so no
pair is made a row; a bucket with very many vectors is cut into chunks on both
sides. Candidates are counted without pairs, from the numbers of vectors that
agree in several tables. Copies of a vector, in the index or among the queries,
are searched once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.blocks import matrix, squared_distances
from tidewright.operators.metrics import average_precision, mean_ap, query_costs, vote_share
from tidewright.operators.order import cap_candidates, group_index
from tidewright.operators.select import thin_candidates
from tidewright.session import cut, stored

CHUNK_ROWS = 1 << 14
#: Tables up to which candidates are counted by sets of tables: 2^n - 1 counts.
COUNTED_TABLES = 6
#: Numbers of a tile of distances.
HELD = 1 << 21


def random_planes(tables: int, planes: int, dim: int, seed: int = 0) -> np.ndarray:
    """Gaussian projections scaled by the square root of the dimension, ``[table, plane, dim]``."""
    return np.random.default_rng(seed).standard_normal((tables, planes, dim)) / np.sqrt(dim)


def bucket_numbers(df: DataFrame, vec: str, planes: np.ndarray, radius: float, name: str = "buckets") -> DataFrame:
    """Array (one entry per table) of bucket tuples ``floor(projection / 2R)``."""
    tables, per_table, dim = planes.shape
    flat = planes.reshape(-1, dim).T
    out_type = pa.list_(pa.list_(pa.int64()))

    def project(batches):
        for batch in batches:
            x = matrix(batch.column(batch.schema.get_field_index(vec))).astype(np.float64)
            n = batch.num_rows
            numbers = np.floor(x @ flat / (2.0 * radius)).astype(np.int64) if n else np.empty(0, np.int64)
            inner = pa.ListArray.from_arrays(
                pa.array(np.arange(0, n * tables * per_table + 1, per_table), pa.int32()), pa.array(numbers.ravel())
            )
            outer = pa.ListArray.from_arrays(pa.array(np.arange(0, n * tables + 1, tables), pa.int32()), inner)
            yield pa.RecordBatch.from_arrays([*batch.columns, outer.cast(out_type)], names=[*batch.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(project, f"{fields}, `{name}` array<array<bigint>>")


def _bucket_keys(df, vec, planes, radius):
    """64-bit key of each table's bucket, in table order."""
    numbered = bucket_numbers(df, vec, planes, radius, "_buckets")
    keys = F.transform("_buckets", lambda b, t: F.xxhash64(t, b))
    return numbered.withColumn("_keys", keys).drop("_buckets")


def pair_distance(df: DataFrame, a: str, b: str, name: str = "dist") -> DataFrame:
    """Euclidean distance of two vector columns, a batch at a time; the vectors are dropped."""
    keep = [c for c in df.columns if c not in (a, b)]

    def measure(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            x, y = matrix(batch.column(at(a))).astype(np.float64), matrix(batch.column(at(b))).astype(np.float64)
            gap = np.sqrt(((x - y) ** 2).sum(axis=1)) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(at(c)) for c in keep], pa.array(gap)], names=[*keep, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.mapInArrow(measure, f"{fields}, `{name}` double")


def _crowded(entries: DataFrame, chunk_rows: int) -> DataFrame | None:
    """Buckets of more than ``chunk_rows`` rows and their number of chunks; None without any."""
    sizes = entries.groupBy("table_id", "key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk_rows)
    sizes = cut(sizes.select("table_id", "key", F.ceil(F.col("_n") / chunk_rows).alias("_chunks")))
    return None if sizes.isEmpty() else sizes


def _chunked(entries: DataFrame, own: DataFrame | None, other: DataFrame | None, names: tuple[str, str], *key) -> DataFrame:
    """Each row in one chunk of its own side, and once for each chunk of the other side, of its bucket."""
    for crowded, name in ((own, names[0]), (other, names[1])):
        if crowded is None:
            entries = entries.withColumn(name, F.lit(0).cast("long"))
            continue
        chunks = F.coalesce("_chunks", F.lit(1).cast("long"))
        place = F.pmod(F.xxhash64(*key), chunks) if crowded is own else F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
        entries = entries.join(crowded, ["table_id", "key"], "left").withColumn(name, place).drop("_chunks")
    return entries.withColumn("_bucket", F.xxhash64("table_id", "key", "_ic", "_qc"))


def _finite(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.isfinite(x).all(axis=1))


def _nearest(x: np.ndarray, y: np.ndarray, image: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``x``, rows of ``y`` and their distance: within ``limit`` and among the ``k`` nearest images, ties and perhaps a few more.

    Products of the matrices choose with a margin for their rounding, distances are those of the differences. ``image`` is sorted.
    """
    out = [[], [], []]
    rows, columns = _finite(x), _finite(y)
    y, image = y[columns], image[columns]
    if not len(rows) or not len(columns):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    starts = np.flatnonzero(np.r_[True, image[1:] != image[:-1]])
    slack = 8 * (x.shape[1] + 8) * np.finfo(float).eps * ((x[rows] ** 2).sum(1).max() + (y**2).sum(1).max())
    step = max(1, HELD // len(columns))
    for i in range(0, len(rows), step):
        at = rows[i: i + step]
        d2 = squared_distances(x[at], y)
        most = np.full(len(at), limit * limit * (1 + 1e-12) + slack)
        if len(starts) > k:
            best = d2 if len(starts) == len(columns) else np.minimum.reduceat(d2, starts, axis=1)
            most = np.minimum(most, np.partition(best, k - 1, axis=1)[:, k - 1] + 2 * slack)
        a, b = np.nonzero(d2 <= most[:, None])
        dist = np.sqrt(((x[at[a]] - y[b]) ** 2).sum(axis=1))
        near = dist <= limit
        for held, new in zip(out, (at[a[near]], columns[b[near]], dist[near])):
            held.append(new)
    return tuple(np.concatenate(v) for v in out)


def _runs(table: pa.Table) -> tuple[pa.Table, dict[int, slice]]:
    """The table sorted by bucket, and where each bucket lies."""
    table = table.take(pc.sort_indices(table, [("_bucket", "ascending"), *[(c, "ascending") for c in ("img_id",) if c in table.column_names]])).combine_chunks()
    bucket = table.column("_bucket").to_numpy()
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    return table, {int(bucket[a]): slice(int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(bucket)])}


# Copies of a vector are told by two 64-bit hashes of it.
COPY = ["_h1", "_h2"]


def _with_copy_key(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumns({"_h1": F.xxhash64(vec), "_h2": F.xxhash64(F.lit(1), vec)})


@dataclass
class LshIndex:
    """Hash tables over vectors ``img_id, patch, vec`` (and a label, when there is one).

    ``entries`` numbers the images that hold the same vector, by id, as
    ``_copy``. All copies are equally far from a query, so of each vector only
    the first k images can be among the k nearest, and a vector that very many
    images share costs k rows, not all of them.
    """

    rows: DataFrame
    entries: DataFrame
    copies: DataFrame
    crowded: DataFrame | None
    planes: np.ndarray
    radius: float
    chunk_rows: int = CHUNK_ROWS

    @classmethod
    def build(cls, df: DataFrame, image: str = "img_id", patch: str | None = None, vec: str = "vec", tables: int = 10,
              planes: int | np.ndarray = 30, radius: float = 100.0, seed: int = 0, label: str | None = None,
              dim: int | None = None, chunk_rows: int = CHUNK_ROWS) -> LshIndex:
        if not isinstance(planes, np.ndarray):
            dim = dim or df.select(F.size(vec)).first()[0]
            planes = random_planes(tables, planes, dim, seed)
        rows = _with_copy_key(df.select(
            F.col(image).alias("img_id"), (F.col(patch) if patch else F.lit(0)).alias("patch"), F.col(vec).alias("vec"),
            (F.col(label) if label else F.lit(None).cast("string")).alias("label"),
        ).filter(F.col("vec").isNotNull()), "vec")
        copies = cut(rows.groupBy(*COPY).agg(F.count(F.lit(1)).alias("_n")))
        # Equal patches of one image: the first stands for them.
        single = rows.groupBy(*COPY, "img_id").agg(F.min(F.struct("patch", "label", "vec")).alias("_r")).select(*COPY, "img_id", "_r.*")
        numbered = group_index(single, COPY, "img_id", "_copy")
        keyed = stored(_bucket_keys(numbered, "vec", planes, radius), "index")  # a vector once, not once for each table
        entries = keyed.select("*", F.posexplode("_keys").alias("table_id", "key"))
        return cls(keyed, entries, copies, _crowded(entries, chunk_rows), planes, radius, chunk_rows)

    def table(self) -> DataFrame:
        """The hash tables: ``table_id, key, img_id, patch``."""
        return self.entries.select("table_id", "key", "img_id", "patch")

    def _distinct(self, queries: DataFrame, query: str, vec: str) -> tuple[DataFrame, DataFrame]:
        """Each different query vector once, and which queries ask it."""
        asked = _with_copy_key(queries.select(F.col(query).alias("query_id"), F.col(vec).alias("q_vec")), "q_vec")
        reps = asked.groupBy(*COPY).agg(F.min(F.struct("query_id", "q_vec")).alias("_r"))
        return reps.select(F.col("_r.query_id").alias("rep"), "_r.q_vec", *COPY), asked.drop("q_vec")

    def _pairs(self, reps: DataFrame, first: int) -> DataFrame:
        """Each (query vector, indexed vector) that shares a bucket, once, with the first shared table.

        Of a vector's copies the ``first`` images take part.
        """
        keyed = _bucket_keys(reps.select("rep", "q_vec"), "q_vec", self.planes, self.radius)
        asked = keyed.withColumnRenamed("_keys", "_q_keys").select("*", F.posexplode("_q_keys").alias("table_id", "key"))
        held = self.entries.filter(F.col("_copy") < first)
        on = ["table_id", "key"]
        if self.crowded is not None:
            chunks = F.coalesce("_chunks", F.lit(1))
            held = held.join(self.crowded, on, "left").withColumn("_chunk", F.pmod(F.xxhash64("img_id", "patch"), chunks)).drop("_chunks")
            asked = asked.join(self.crowded, on, "left").withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).drop("_chunks")
            on = [*on, "_chunk"]
        joined = asked.join(held, on)
        earlier = F.exists(
            F.slice(F.zip_with("_q_keys", "_keys", lambda a, b: a == b), F.lit(1), F.col("table_id")), lambda same: same
        )
        return joined.filter(~earlier).select("rep", "q_vec", "vec", *COPY, "table_id", "img_id", "patch", "label")

    def query(self, queries: DataFrame, k: int, c: float, subsample: float = 1.0, query: str = "query_id", vec: str = "vec",
              compat: bool = False, seed: int = 0, table_limit: int | None = None) -> DataFrame:
        """The ``k`` nearest of the vectors within ``c * R`` that share a bucket, one patch per image.

        An image stands by its nearest patch. ``compat`` takes the patch met
        first (table, then patch order), even if that one is then too far.
        ``table_limit`` ends the search of a table after so many accepted
        candidates. With ``subsample`` candidates are left out at random. Each
        of these three can pass over a copy, so then all copies take part.
        """
        reps, asked = self._distinct(queries, query, vec)
        if not compat and table_limit is None and subsample >= 1.0:
            best = self._best(reps, k, c * self.radius).groupBy("rep", "img_id").agg(F.min(F.struct("dist", "patch", "table_id", "label")).alias("_b"))
            return self._ranked(best.select("rep", "img_id", "_b.*"), reps, asked, k)
        pairs = self._pairs(reps, 1 << 62).drop(*COPY)
        if subsample < 1.0:
            pairs = thin_candidates(pairs, subsample, seed, ["rep", "img_id", "patch"])
        scored = pair_distance(pairs, "q_vec", "vec")
        near = F.col("dist") <= c * self.radius
        if compat:
            met = scored.groupBy("rep", "img_id").agg(F.min(F.struct("table_id", "patch", "dist", "label")).alias("_b"))
            one = met.select("rep", "img_id", "_b.*").filter(near)
        else:
            best = scored.filter(near).groupBy("rep", "img_id").agg(F.min(F.struct("dist", "patch", "table_id", "label")).alias("_b"))
            one = best.select("rep", "img_id", "_b.*")
        if table_limit is not None:
            one = cap_candidates(one, ["rep", "table_id"], ["img_id", "patch"], table_limit)
        return self._ranked(one, reps, asked, k)

    def _best(self, reps: DataFrame, k: int, limit: float) -> DataFrame:
        """Of each query vector and bucket the images that can be among the ``k`` nearest within ``limit``: ``rep, img_id, patch, label, table_id, dist``.

        The k nearest of all buckets are among the k nearest of each, so a task hands on a few rows for each query and bucket.
        """
        keyed = _bucket_keys(reps.select("rep", "q_vec").filter(F.col("q_vec").isNotNull()), "q_vec", self.planes, self.radius)
        asked = stored(keyed, "asked").select("rep", "q_vec", F.posexplode("_keys").alias("table_id", "key"))
        crowd = _crowded(asked, self.chunk_rows)
        held = self.entries.filter(F.col("_copy") < k).select("img_id", "patch", "vec", "label", "table_id", "key")
        held = _chunked(held, self.crowded, crowd, ("_ic", "_qc"), "img_id", "patch", "vec").drop("key", "_ic", "_qc")
        asked = _chunked(asked, crowd, self.crowded, ("_qc", "_ic"), "rep", "q_vec").drop("table_id", "key", "_ic", "_qc")
        context = held.sparkSession.sparkContext
        parts = max(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism)

        def dealt(frame):  # so many buckets to a task; the number is fixed, as little data can be much work
            return frame.withColumn("_part", F.pmod("_bucket", F.lit(16 * parts))).repartition(parts, "_part").groupBy("_part")

        names = ["rep", "img_id", "patch", "label", "table_id", "dist"]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            (left, asks), (right, holds) = _runs(left), _runs(right)
            found = []
            for bucket in asks.keys() & holds.keys():
                mine, theirs = (t.slice(s.start, s.stop - s.start) for t, s in ((left, asks[bucket]), (right, holds[bucket])))
                x, y = (matrix(t.column(v)).astype(np.float64) for t, v in ((mine, "q_vec"), (theirs, "vec")))
                images = theirs.column("img_id").combine_chunks().dictionary_encode("encode").indices.to_numpy()
                a, b, dist = _nearest(x, y, images, k, limit)
                chosen = theirs.select(names[1:5]).take(pa.array(b))
                found.append(pa.table([mine.column("rep").take(pa.array(a)), *chosen.columns, pa.array(dist)], names))
            if found:
                return pa.concat_tables(found)
            empty = [left.schema.field("rep").type, *[right.schema.field(n).type for n in names[1:5]], pa.float64()]
            return pa.table([pa.array([], t) for t in empty], names)

        kinds = dict(reps.dtypes) | dict(held.dtypes)
        schema = ", ".join(f"`{n}` {kinds[n]}" for n in names[:5]) + ", dist double"
        return dealt(asked).cogroup(dealt(held)).applyInArrow(run, schema)

    def _ranked(self, one: DataFrame, reps: DataFrame, asked: DataFrame, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("rep").orderBy("dist", "img_id", "patch"))
        ranked = one.withColumn("rank", rank).filter(F.col("rank") <= k)
        same = asked.join(reps.select("rep", *COPY), COPY)
        return same.join(ranked, "rep").select("query_id", "img_id", "patch", "label", "dist", "rank")

    def computed(self, queries: DataFrame, query: str = "query_id", vec: str = "vec") -> DataFrame:
        """Candidates of each query: vectors that share a bucket, copies counted, without listing them.

        For each set of tables those that agree with the query in all of them are a plain count; vectors that share any bucket follow by
        inclusion and exclusion, so the work grows with the rows. Very many tables have too many sets, then pairs are counted. A query without any has no row.
        """
        tables = self.planes.shape[0]
        if tables <= COUNTED_TABLES:
            sets = [[t for t in range(tables) if m >> t & 1] for m in range(1, 1 << tables)]
            spread = F.explode(F.array(*[
                F.struct(F.lit(m).alias("m"), F.lit(1 if len(s) % 2 else -1).alias("sign"), F.xxhash64(F.lit(m), *[F.col("_keys")[t] for t in s]).alias("h"))
                for m, s in enumerate(sets)])).alias("s")
            held = self.rows.filter(F.col("_copy") == 0).join(self.copies, COPY).groupBy("_keys").agg(F.sum("_n").alias("_n"))
            counts = held.select(spread, "_n").groupBy("s.m", "s.h").agg(F.sum("_n").alias("_n"))
            named = queries.select(F.col(query).alias("query_id"), F.col(vec).alias("q_vec")).filter(F.col("q_vec").isNotNull())
            keyed = stored(_bucket_keys(named, "q_vec", self.planes, self.radius).select("query_id", "_keys"), "asked")
            asked = keyed.select("_keys").distinct().select("_keys", spread).select("_keys", "s.*")
            totals = asked.join(counts, ["m", "h"]).groupBy("_keys").agg(F.sum(F.col("sign") * F.col("_n")).alias("n_computed"))
            return keyed.join(totals.filter(F.col("n_computed") > 0), "_keys").select("query_id", "n_computed")
        reps, asked = self._distinct(queries, query, vec)
        met = self._pairs(reps, 1).select("rep", *COPY).join(self.copies, COPY)
        totals = met.groupBy("rep").agg(F.sum("_n").alias("n_computed"))
        same = asked.join(reps.select("rep", *COPY), COPY)
        return same.join(totals, "rep").select("query_id", "n_computed")

    def evaluate(self, queries: DataFrame, classes, ks, c: float, query: str = "query_id", vec: str = "vec", label: str = "label",
                 background=None, compat: bool = False) -> DataFrame:
        """mAP and mean costs of a labelled query set, one row for each ``k``.

        Neighbours are searched once for the largest ``k``; smaller ones are its first ranks.
        """
        found = cut(self.query(queries, max(ks), c, query=query, vec=vec, compat=compat))
        computed = cut(self.computed(queries, query, vec))
        truth = queries.select(F.col(query).alias("query_id"), F.col(label).alias("_truth"))
        out = None
        for k in ks:
            nearest = found.filter(F.col("rank") <= k)
            votes = vote_share(nearest, classes).join(truth, "query_id")
            hits = votes.withColumn("_hit", (F.col("class_name") == F.col("_truth")).cast("int"))
            ap = average_precision(hits, "_hit", "score", ["class_name"])
            cost = query_costs(nearest, compat, computed)
            row = mean_ap(ap, skip_nan=True, without=background).select(F.lit(k).alias("k"), "map")
            row = row.join(cost.withColumn("k", F.lit(k)), "k")
            out = row if out is None else out.unionByName(row)
        return out
