"""Exact n-gram Jaccard join with count-vector R-tree leaves.

A text's set is its distinct word 5-grams, each a 64-bit number. The numbers are dealt into groups by their low bits; the
counts per group are the set's point. Sets share at most the sum of the coordinate minima, a leaf's largest counts bound all its
points at once, and pairs that pass both bounds are verified on the whole sets.

A point has about half as many coordinates as its set has members, and no tree splits so many dimensions well. The
root is therefore a prefix of the set: in one fixed order of all n-grams two sets with Jaccard similarity t or more
share one of their first (1 - t) n + 1 members. Only sets that meet there come into question, and no link is lost,
whatever the order. The order puts rare n-grams first, so that passages which many texts share leave the prefixes; rarity is
a table of fixed size, the counts of hashed n-grams over all rows.

1. Counts of n-grams; then sets, points and prefixes per row; equal sets are one *class* from here on.
2. Prefix members that several classes share; of members with the same classes one stands for all.
3. Rounds of pivots: each class is tested against one seeded class of each of its members, if they are not joined yet (a
   star, not all pairs); links join classes to components.
4. In members that still hold several components, all rows outside the largest one are queries. Rows of equal and adjacent
   size bands fill leaves of bounded size, and a leaf of queries with a leaf of points is a cell. What passes the bounds of a
   cell gets its whole sets and is verified in the cell, which emits no more links than join its components.

No group is gathered whole, no pair is made between classes that are joined already, cells emit rows or spanning links but
never pairs of candidates, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import claim, slices, store, text_bytes
from tidewright.llm.components import components

#: Words of an n-gram and the least similarity in percent.
WORDS_PER_GRAM, PERCENT = 5, 80
#: Classes in a leaf, about, and members of all its sets together (a larger set is a leaf of its own).
LEAF_CLASSES, LEAF_MEMBERS = 256, 1 << 16
#: Rounds of pivots before the leaves.
PIVOT_ROUNDS = 2
#: Bytes of text whose words are hashed at a time (a longer text is taken whole).
BLOCK_BYTES = 1 << 18
#: Bits of the filter that spares texts of untested classes the shuffle: 2 MB, whatever the input.
FILTER_BITS = 1 << 24
#: Counts of hashed n-grams that order the prefixes, in rows of so many.
RARITY, RARITY_ROW = 1 << 20, 1 << 12

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A number for each byte and a factor for each place in a word.
_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * _FACTORS[0])
_PLACE_FACTOR = np.uint64(0x9FB21C651E98DF2B)
_SOLID = np.array([i not in b" \t\n\v\f\r" for i in range(256)])


def _word_hashes(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in bytes: sums of the bytes' numbers times a power for the place in the word."""
    solid = _SOLID[flat]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    first = np.cumsum(sizes) - sizes
    powers = np.cumprod(np.full(int(sizes.max()), _PLACE_FACTOR))
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    return _mixed(np.add.reduceat(_VALUES[flat[solid]] * powers[place], first)), starts


def gram_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Distinct n-grams of each text, ascending.

    A-Z is lowered and words end at ASCII white space; a text of fewer words is one n-gram, without words it has none.
    """
    block: list[bytes] = []
    size = 0
    for text in texts:
        if block and size + len(text) > BLOCK_BYTES:
            yield from _block_sets(block)
            block, size = [], 0
        block.append(text)
        size += len(text)
    yield from _block_sets(block)


def _block_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    h, starts = _word_hashes(np.frombuffer(b"\n".join(texts).lower(), np.uint8))
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
    total = np.full(max(0, len(h) - WORDS_PER_GRAM + 1), WORDS_PER_GRAM, np.uint64)
    for i in range(WORDS_PER_GRAM):
        total += h[i: i + len(total)] * _FACTORS[i]
    total = _mixed(total)
    for start, end in zip([0, *ends], ends):
        n = end - start
        if 0 < n < WORDS_PER_GRAM:
            yield _mixed((h[start: end] * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
            continue
        members = np.sort(total[start: max(start, end - WORDS_PER_GRAM + 1)])
        yield members[np.diff(members, prepend=~members[:1]) != 0]


def gram_set(text: bytes) -> np.ndarray:
    return next(gram_sets([text]))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Members of which a similar set must share one."""
    return n + (-percent * n // 100) + 1 if n else 0


def point(members: np.ndarray) -> bytes:
    """Counts per group; the number of groups is a power of two near half the members. 255 stands for 255 or more."""
    groups = 1 << max(4, int(len(members) // 3).bit_length())
    counts = np.bincount((members & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _folded(points: list[bytes], groups: int) -> np.ndarray:
    """Points as rows of equally many coordinates; a count that was cut bounds nothing, so it becomes huge."""
    rows = np.empty((len(points), groups), np.int32)
    for i, p in enumerate(points):
        p = np.frombuffer(p, np.uint8).astype(np.int32)
        p[p == 255] = 1 << 20
        rows[i] = p.reshape(-1, groups).sum(0)
    return rows


def needed(a, b, percent: int = PERCENT):
    """Least overlap of sets of a and b members that are similar: ceil(p (a + b) / (100 + p))."""
    return -(-percent * (a + b) // (100 + percent))


def may_be_similar(points_a: list[bytes], points_b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Pairwise over two lists: whether sizes and the sum of minima allow a link."""
    out = np.zeros(len(n_a), bool)
    widths = np.fromiter((min(len(a), len(b)) for a, b in zip(points_a, points_b)), np.int64, len(n_a))
    fits = 100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)
    for width in np.unique(widths[fits]):
        at = np.flatnonzero((widths == width) & fits)
        a = _folded([points_a[i] for i in at], int(width))
        b = _folded([points_b[i] for i in at], int(width))
        out[at] = np.minimum(a, b).sum(1) >= needed(n_a[at], n_b[at])
    return out


def _as_lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)))


def _from_lists(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    return [values[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _place(members: np.ndarray) -> np.ndarray:
    return (members & np.uint64(RARITY - 1)).astype(np.int64)


def rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Eighths of the logarithm of the count of n-grams in each of ``RARITY`` places, over all rows.

    Each task counts into a table of its own; the tables are summed row by row, and only the sum, of ``RARITY`` bytes, reaches
    the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard", lambda: None)
        counts = np.zeros(RARITY, np.int32)
        for batch in slices(batches):
            found = np.concatenate([np.empty(0, np.uint64), *gram_sets(text_bytes(batch.column(0)))])
            counts += np.bincount(_place(found), minlength=RARITY).astype(np.int32)
        yield from _rows_of({i: row for i, row in enumerate(counts.reshape(-1, RARITY_ROW)) if row.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[at] = sums.get(at, 0) + np.frombuffer(row, np.int32).astype(np.int64)
        yield from _rows_of({at: np.minimum(8 * np.log2(1 + row), 255).astype(np.uint8) for at, row in sums.items()})

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "at int, row binary")
    found = counted.repartition("at").mapInArrow(add, "at int, row binary").collect()
    level = np.zeros((RARITY // RARITY_ROW, RARITY_ROW), np.uint8)
    for at, row in found:
        level[at] = np.frombuffer(row, np.uint8)
    return level.ravel()


def _rows_of(rows: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    columns = [pa.array(list(rows), pa.int32()), pa.array([row.tobytes() for row in rows.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["at", "row"])


def prefix(members: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The members that decide, in the fixed order: rare places first, then the numbers."""
    return members[np.argsort(level[_place(members)], kind="stable")[: prefix_size(len(members))]]


def text_key(text: bytes) -> int:
    """64-bit name of a text, by which its set need not be made to find it again."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.lower())).view(np.int64))


def sets(docs: DataFrame, level: np.ndarray, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n, class, key, point, prefix of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(level)  # RARITY bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard", lambda: None)
        for batch in slices(batches):
            texts = text_bytes(batch.column(1))
            found = list(gram_sets(texts))
            longs = [[len(m) for m in found], [class_name(m) for m in found], [text_key(t) for t in texts]]
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in longs), pa.array([point(m) for m in found], pa.binary())]
            columns.append(_as_lists([prefix(m, shared.value) for m in found]))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "class", "key", "point", "prefix"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, class long, key long, point binary, prefix array<long>")


def class_name(members: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(members.tobytes())).view(np.int64))


def _meetings(full: DataFrame) -> DataFrame:
    """member, class of members that several classes hold in their prefixes.

    Of members with the same classes one stands for all: they are told by the number of classes and 128 bits over their names.
    """
    held = full.groupBy("class").agg(F.first("prefix").alias("prefix"))
    exploded = held.select("class", F.explode("prefix").alias("member")).where("member is not null").repartition("member")
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "class")).alias(f"_x{seed}") for seed in (0, 1)]
    shared = exploded.groupBy("member").agg(F.count("*").alias("_n"), *marks).where("_n > 1")
    once = shared.groupBy("_n", "_x0", "_x1").agg(F.min("member").alias("member")).select("member")
    return exploded.join(once, "member").select("member", "class")


def _filter_of(keys: DataFrame) -> np.ndarray:
    """Bits of the keys, set on the executors; at most FILTER_BITS / 64 numbers come to the driver."""
    bit = F.pmod(F.col("key"), F.lit(FILTER_BITS))
    words = keys.select((bit / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, CAST(pmod(pmod(key, {FILTER_BITS}), 64) AS INT))").alias("v"))
    found = words.groupBy("w").agg(F.bit_or("v").alias("v")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["w"].to_numpy(np.int64)] = found["v"].to_numpy(np.int64)
    return bits


def _whole_sets(docs: DataFrame, asked: DataFrame, text_col: str) -> DataFrame:
    """class, members for the classes asked for (class, key; and some more, as the filter allows), one row each."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(asked.select("key")))  # 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard", lambda: None)
        bits = shared.value
        for batch in slices(batches):
            texts = text_bytes(batch.column(0))
            places = [text_key(t) % FILTER_BITS for t in texts]
            chosen = {t.lower() for t, bit in zip(texts, places) if int(bits[bit // 64]) >> bit % 64 & 1}
            found = [m for m in gram_sets(list(chosen)) if len(m)]
            columns = [pa.array([class_name(m) for m in found], pa.int64()), _as_lists(found)]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "members"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "class long, members array<long>")
    return found.groupBy("class").agg(F.first("members").alias("members"))


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and points allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            points = [batch.column(i).to_pylist() for i in (2, 3)]
            ok = may_be_similar(*points, batch.column(4).to_numpy(), batch.column(5).to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    def side(name: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.col("point").alias(f"point_{name}"), F.col("n").alias(f"n_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "point_a", "point_b", "n_a", "n_b")
    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """Pairs whose whole sets are similar."""
    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    whole = store(_whole_sets(docs, classes.join(ends, "class", "left_semi"), text_col), "whole-sets")
    one = pairs.join(whole.select(F.col("class").alias("a"), F.col("members").alias("_a")), "a")
    both = one.join(whole.select(F.col("class").alias("b"), F.col("members").alias("_b")), "b")
    common = F.size(F.array_intersect("_a", "_b"))
    return both.where(100 * common >= PERCENT * (F.size("_a") + F.size("_b") - common)).select("a", "b")


def _placed(met: DataFrame, joined: DataFrame | None) -> DataFrame:
    """member, class, n and the class's component, named by itself while it has no link."""
    if joined is None:
        return met.withColumn("comp", F.col("class"))
    named = met.join(joined.withColumnRenamed("node", "class"), "class", "left")
    return named.select("member", "class", "n", F.coalesce("comp", "class").alias("comp"))


def _pivot_pairs(placed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): in each member with several components one seeded class, and the classes not yet joined to it."""
    order = F.struct(F.xxhash64(F.lit(turn), "class").alias("h"), "class", "comp", "n")
    pivots = placed.groupBy("member").agg(F.min(order).alias("_p"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
    both = placed.join(pivots.where("_lo <> _hi").select("member", "_p"), "member").where("comp <> _p.comp")
    both = both.where(100 * F.least("n", "_p.n") >= PERCENT * F.greatest("n", "_p.n"))
    return both.select(F.least("class", "_p.class").alias("a"), F.greatest("class", "_p.class").alias("b")).distinct()


def _linked_by_pivots(met: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame | None:
    """node, comp: components made by the links that rounds of pivots find."""
    joined = None
    for turn in range(PIVOT_ROUNDS):
        pairs = store(_bounded(_pivot_pairs(_placed(met, joined), turn), classes), "pairs")
        links = _verified(pairs, classes, docs, text_col)
        if joined is not None:
            links = links.unionByName(joined.select(F.col("node").alias("a"), F.col("comp").alias("b")))
        joined = components(links)
    return joined


def _cells(rows: DataFrame) -> DataFrame:
    """cell, side, class, comp, minor, n from rows (member, class, comp, n) of members with several components.

    Rows outside a member's largest component are *minor*: each open pair has one of them at least. Similar sets differ in
    size by a quarter at most, so they lie in the same or in adjacent bands of that ratio. Minor rows are dealt into leaves of
    queries, all rows into leaves of points, and a cell is a leaf of queries with a leaf of points of its band or the bands around it.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    sizes = rows.groupBy("member", "comp").agg(F.count("*").alias("_n"))
    largest = sizes.groupBy("member").agg(F.max(F.struct("_n", "comp")).alias("_m"), F.sum("_n").alias("_all"))
    largest = largest.select("member", F.col("_m.comp").alias("_major"), (F.col("_all") - F.col("_m._n")).alias("_minors"))
    minor = (F.col("comp") != F.col("_major")).alias("minor")
    banded = rows.join(largest, "member").select("member", "class", "comp", "n", "_minors", minor, band.alias("band"))
    counts = banded.groupBy("member", "band").agg(F.count("*").alias("_n"), F.count_if("minor").alias("_q"), F.max("n").alias("_most"))
    each = F.greatest(F.lit(1), F.least(F.lit(LEAF_CLASSES), F.floor(F.lit(LEAF_MEMBERS) / F.col("_most")))).cast("long")
    leaves = counts.select(
        "member", "band", F.ceil(F.col("_n") / each).cast("int").alias("_points"), F.ceil(F.col("_q") / each).cast("int").alias("_queries"),
    )
    near = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.struct((F.col("band") + d).alias("band"), (-d).alias("by"), "_points", "_queries"))
    around = leaves.select("member", F.explode(near).alias("_l")).groupBy("member", F.col("_l.band").alias("band")).agg(
        F.collect_list("_l").alias("_near"),  # three at most
    )
    own = leaves.join(around, ["member", "band"])
    hashed = F.xxhash64("class", "member")
    dealt = banded.join(own, ["member", "band"]).withColumns({
        "_i": F.pmod(hashed, F.greatest("_queries", F.lit(1))).cast("int"), "_j": F.pmod(hashed, "_points").cast("int"),
    })

    def partners(side: str, count: str, cell) -> Column:
        """Cells with each leaf of the bands around; a band without such leaves gives none."""
        lists = F.transform("_near", lambda l: F.transform(
            F.slice(F.sequence(F.lit(0), F.greatest(l[count], F.lit(1)) - 1), F.lit(1), l[count]),
            lambda k: F.struct(F.lit(side).alias("side"), cell(l, k).alias("cell")),
        ))
        return F.flatten(lists)

    def cell(queries, points, i, j):
        return F.struct("member", queries.alias("queries"), points.alias("points"), i.alias("i"), j.alias("j"))

    as_query = partners("q", "_points", lambda l, k: cell(F.col("band"), F.col("band") + l["by"], F.col("_i"), k))
    as_point = partners("p", "_queries", lambda l, k: cell(F.col("band") + l["by"], F.col("band"), k, F.col("_j")))
    none = F.slice(as_query, 1, 0)
    met = ~F.col("minor") | (F.col("_minors") > 1)  # a lone minor row has no other to meet it
    both = F.concat(F.when(F.col("minor"), as_query).otherwise(none), F.when(met, as_point).otherwise(none))
    return dealt.select("class", "comp", "minor", "n", F.explode(both).alias("_c")).select("_c.cell", "_c.side", "class", "comp", "minor", "n")


_ROW = "cell struct<member:bigint,queries:int,points:int,i:int,j:int>, side string, class long, comp long"


def _survivors(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of cells that some row of the other side may be similar to, by the bounds of points and corners."""
    full = cells.join(classes.select("class", "point"), "class")
    met = full.groupBy("cell").agg(F.collect_list(F.struct("side", "class", "comp", "n", "point")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            at, kept = [], []
            for i, rows in enumerate(batch.column(1).to_pylist()):
                left, right = ([r for r in rows if r["side"] == side] for side in "qp")
                found = {c for pair in _leaf_join(left, right) for c in pair} if left and right else set()
                here = [r for r in rows if r["class"] in found]
                at += [i] * len(here)
                kept += here
            columns = [pa.array([r[c] for r in kept], t) for c, t in (("side", pa.string()), ("class", pa.int64()), ("comp", pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *columns], names=["cell", "side", "class", "comp"])

    return met.select("cell", "rows").mapInArrow(run, _ROW)


def _leaf_join(a: list[dict], b: list[dict]) -> Iterator[tuple[int, int]]:
    """Pairs of different components: points of one leaf against the other leaf's upper corner, then against its points."""
    groups = min(len(r["point"]) for r in (*a, *b))
    pa_, pb = (_folded([r["point"] for r in rows], groups) for rows in (a, b))
    na, nb = (np.array([r["n"] for r in rows], np.int64) for rows in (a, b))
    corner = np.minimum(pa_, pb.max(0)).sum(1) >= needed(na, nb.min())
    for i in np.flatnonzero(corner):
        ok = np.minimum(pb, pa_[i]).sum(1) >= needed(nb, na[i])
        ok &= 100 * np.minimum(nb, na[i]) >= PERCENT * np.maximum(nb, na[i])
        for j in np.flatnonzero(ok):
            if a[i]["comp"] != b[j]["comp"]:
                yield min(a[i]["class"], b[j]["class"]), max(a[i]["class"], b[j]["class"])


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Members that each set of one list shares with each of the other: products of bit matrices, by blocks of columns."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(a), len(b)), np.int64)
    sides = []
    for parts, flat in ((a, flat_a), (b, flat_b)):
        row = np.repeat(np.arange(len(parts)), [len(m) for m in parts])
        hit = np.isin(flat, shared)
        sides.append((len(parts), row[hit], np.searchsorted(shared, flat[hit])))
    for start in range(0, len(shared), 4096):
        bits = []
        for rows, row, column in sides:
            here = (column >= start) & (column < start + 4096)
            matrix = np.zeros((rows, 4096), np.float32)
            matrix[row[here], column[here] - start] = 1
            bits.append(matrix)
        out += (bits[0] @ bits[1].T).astype(np.int64)
    return out


def spanning(q: list[tuple[int, int, np.ndarray]], p: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Links (class, class) between the (class, comp, members) of two sides that join components not joined before."""
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    common = overlaps([m for *_, m in q], [m for *_, m in p])
    size_q, size_p = (np.array([len(m) for *_, m in side], np.int64) for side in (q, p))
    similar = 100 * common >= PERCENT * (size_q[:, None] + size_p[None, :] - common)
    for i, j in zip(*np.nonzero(similar)):
        one, other = top(q[i][1]), top(p[j][1])
        if one != other:
            root[max(one, other)] = min(one, other)
            yield q[i][0], p[j][0]


def _cell_links(survivors: DataFrame, whole: DataFrame) -> DataFrame:
    """Links (a, b) of cells, verified on whole sets; no more of a cell than join its components."""
    full = survivors.join(whole, "class")
    met = full.groupBy("cell").agg(F.collect_list(F.struct("side", "class", "comp", "members")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            lists = batch.column(0)
            rows, ends = lists.values, lists.offsets.to_pylist()
            found: set[tuple[int, int]] = set()
            for start, end in zip(ends[:-1], ends[1:]):
                part = rows.slice(start, end - start).flatten()
                side, names, comps = (column.to_pylist() for column in part[:3])
                held = list(zip(names, comps, _from_lists(part[3])))
                sides = ([h for h, s in zip(held, side) if s == which] for which in "qp")
                found.update(spanning(*sides))
            ordered = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in ordered], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return met.select("rows").mapInArrow(run, "a long, b long").distinct()


def similar_components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and class of each row.

    Null, empty and blank texts have no n-grams and link with nothing: each is its own component. Equal sets link at
    similarity 1. Repeated rows stay; rows that share an id share nothing else, and a null id is smaller than none: its
    component is named by its smallest id, null if it has none. An empty table gives an empty result.
    """
    rows = store(sets(docs, rarity(docs, text_col), text_col, id_col), "sets")
    full = rows.where("n > 0")
    shared = store(_meetings(full), "met")
    asked = full.join(shared.select("class").distinct(), "class", "left_semi")
    classes = store(asked.groupBy("class").agg(*[F.first(c).alias(c) for c in ("n", "key", "point")]), "classes")
    met = store(shared.join(classes.select("class", "n"), "class").select("member", "class", "n"), "met")

    joined = _linked_by_pivots(met, classes, docs, text_col)
    placed = _placed(met, joined)
    mixed = placed.groupBy("member").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a <> _b").select("member")
    open_rows = store(placed.join(mixed, "member"), "open")
    survivors = store(_survivors(_cells(open_rows), classes), "survivors")
    whole = store(_whole_sets(docs, classes.join(survivors, "class", "left_semi"), text_col), "whole-sets")
    more = _cell_links(survivors, whole)
    found = components(joined.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more))

    named = rows.join(found.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("_name", F.when(F.col("n") > 0, F.coalesce("comp", "class")))
    least = named.where("n > 0").groupBy("_name").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(least, "_name", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "class", F.col("_name").alias("group"))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows and columns of ``docs`` with one row of each component: that of the smallest id (a null id is smallest).

    Of rows that also share id and set, any one stays. Rows without n-grams stay all.
    """
    found = store(similar_components(docs, text_col, id_col).where("n_shingles > 0"), "components")
    least = found.groupBy("group").agg(F.min(F.struct("doc_id", "class")).alias("_r")).select("_r.*")
    counts = found.groupBy("doc_id", "class").agg(F.count("*").alias("_rows"))
    same = F.col("l.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("l.class") == F.col("c.class"))
    stay = store(least.alias("l").join(counts.alias("c"), same).select(
        F.col("l.doc_id").alias("_id"), F.col("l.class").alias("_kept"), "_rows"
    ), "kept")
    columns = docs.columns
    named = docs.mapInArrow(_namer(columns, text_col), docs.withColumn("_class", F.lit(None).cast("long")).schema)
    match = F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_class") == F.col("_kept"))
    kept = named.join(stay, match, "left").where("_class is null or _kept is not null")
    if stay.where("_rows > 1").isEmpty():
        return kept.select(*columns)
    once = kept.where("_class is null or _rows = 1").select(*columns)
    return once.unionByName(kept.where("_rows > 1").dropDuplicates(["_id", "_class"]).select(*columns))


def _namer(columns: list[str], text_col: str):
    """Adds the class of each row's set, null without n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard", lambda: None)
        for batch in slices(batches):
            found = gram_sets(text_bytes(batch.column(text_col)))
            names = pa.array([class_name(m) if len(m) else None for m in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), names], names=[*columns, "_class"])

    return run
