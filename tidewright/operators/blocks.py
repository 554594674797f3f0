"""Matrix work on vector columns: Gram matrix, distance tiles, kernel components.

A point set of n vectors has n * n distances; where these are too many,
``landmarks`` draws a subset. Points are cut into blocks of fixed size and the unit of work is one pair of blocks (a tile).
Tiles are balanced by construction. Sums, products and components use a tile when it is there and drop it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.keys import hash_unit
from tidewright.operators.order import row_index
from tidewright.operators.select import sample_n
from tidewright.session import discard, stored, tidy_shuffles

BLOCK = 256
#: Columns of a block of the Gram matrix.
GRAM_BLOCK = 1024


def matrix(column) -> np.ndarray:
    """Arrow list column to a 2-D array without a Python loop; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def gram(df: DataFrame, vec: str, norm: float = 1.0) -> DataFrame:
    """``sum over rows of v[i] * v[j]``, divided by ``norm``; one row for each (i, j).

    A row is one place, its array the values of all filters there. Each task
    sums its own outer products while they fit one block, so only one small matrix per task is
    shuffled; wider ones leave block by block.
    """
    def cells(total, row, column):
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel() + row, pa.int32()), pa.array(j.ravel() + column, pa.int32()), pa.array(total.ravel())]
        return pa.RecordBatch.from_arrays(columns, names=["i", "j", "g"])

    def partial(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0)).astype(np.float64)
            if x.shape[1] <= GRAM_BLOCK:
                total = x.T @ x if total is None else total + x.T @ x
                continue
            starts = range(0, x.shape[1], GRAM_BLOCK)
            for row in starts:
                for column in starts:
                    yield cells(x[:, row: row + GRAM_BLOCK].T @ x[:, column: column + GRAM_BLOCK], row, column)
        if total is not None:
            yield cells(total, 0, 0)

    parts = df.filter(F.col(vec).isNotNull()).select(vec).mapInArrow(partial, "i int, j int, g double")
    return parts.groupBy("i", "j").agg((F.sum("g") / F.lit(float(norm))).alias("g"))


def landmarks(df: DataFrame, id: str, n: int, seed: int) -> DataFrame:
    """``n`` points drawn for kernel work on a set too large for all distances."""
    return sample_n(df.withColumn("_all", F.lit(0)), n, "_all", id, seed).drop("_all")


def point_blocks(df: DataFrame, id: str, vec: str, block: int = BLOCK) -> DataFrame:
    """Points packed as one row per block: block number, ids and the stacked vectors."""
    numbered = row_index(df.select(id, vec), id, "_idx")
    packed = numbered.groupBy(F.floor(F.col("_idx") / block).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("_idx", F.col(id).alias("id"), F.col(vec).alias("v")))).alias("p")
    )  # at most ``block`` points per group
    return packed.select(
        "block", F.col("p.id").alias("ids"), F.flatten("p.v").cast("array<double>").alias("values")
    )


def distance_tiles(blocks: DataFrame) -> DataFrame:
    """Squared distances of each pair of blocks, one dense tile per row.

    Each block is sent to the row and to the column of tiles it takes part in
    and the tiles meet in an equi join, so every task has the same work.
    """
    count = blocks.count()
    other = F.explode(F.sequence(F.lit(0), F.lit(max(count, 1) - 1)))
    left = blocks.select(F.col("block").alias("bi"), other.alias("bj"), F.col("ids").alias("ids_i"), F.col("values").alias("vi"))
    right = blocks.select(F.col("block").alias("bj"), other.alias("bi"), F.col("ids").alias("ids_j"), F.col("values").alias("vj"))
    pairs = left.join(right, ["bi", "bj"]).select("bi", "bj", "ids_i", "ids_j", "vi", "vj")

    def tile(frames):
        for frame in frames:
            out = []
            for ids_i, ids_j, vi, vj in zip(frame.ids_i, frame.ids_j, frame.vi, frame.vj):
                out.append(squared_distances(vi.reshape(len(ids_i), -1), vj.reshape(len(ids_j), -1)).ravel())
            yield pd.DataFrame({"bi": frame.bi, "bj": frame.bj, "ids_i": frame.ids_i, "ids_j": frame.ids_j, "tile": out})

    return pairs.mapInPandas(tile, "bi int, bj int, ids_i array<long>, ids_j array<long>, tile array<double>")


def all_pairs(df: DataFrame, id: str, vec: str, block: int = BLOCK) -> DataFrame:
    """The distance matrix in long form: ``i``, ``j`` and squared distance ``d2``."""
    tiles = distance_tiles(point_blocks(df, id, vec, block))
    rows = tiles.select(
        F.explode(F.arrays_zip("ids_i", F.transform(
            F.sequence(F.lit(0), F.size("ids_i") - 1),
            lambda r: F.slice("tile", r * F.size("ids_j") + 1, F.size("ids_j")),
        ).alias("d"))).alias("r"), "ids_j",
    )
    return rows.select(F.col("r.ids_i").alias("i"), F.explode(F.arrays_zip(F.col("ids_j").alias("j"), F.col("r.d").alias("d2"))).alias("c")) \
        .select("i", "c.j", "c.d2")


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d2 = x @ y.T
    d2 *= -2
    d2 += (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :]
    return np.maximum(d2, 0.0, out=d2)


#: Points of a group at most, fewest groups (of one block at least) that share the work, and numbers of a tile that a task holds.
GROUP_POINTS = 1 << 14
GROUPS = 16
HELD = 1 << 17


def _paired(points: DataFrame, extra: str, block: int) -> DataFrame:
    """The blocks of both groups of each pair of groups: ``gi, gj, left, block, ids, values, extra``.

    A block is sent once for each group, so with groups as large as a task can hold little is sent, however many tiles there are.
    """
    last = points.agg(F.max("block")).first()[0]
    blocks = 0 if last is None else int(last) + 1
    groups = max(1, -(-blocks * block // GROUP_POINTS), min(blocks, GROUPS))
    each = max(1, -(-blocks // groups))
    groups = max(1, -(-blocks // each))
    own = F.floor(F.col("block") / each).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("other")
    sent = points.select(own.alias("own"), other, "block", "ids", "values", F.col(extra).alias("extra"))
    sent = sent.select(F.least("own", "other").alias("gi"), F.greatest("own", "other").alias("gj"), (F.col("own") <= F.col("other")).alias("left"),
                       "block", "ids", "values", "extra")
    return sent.repartition(min(4096, groups * (groups + 1) // 2), "gi", "gj")


def tile_sums(points: DataFrame, extra: str, rows_of, kernel=None, block: int = BLOCK) -> DataFrame:
    """``rows_of(k, own, other)`` summed over all points, by block: ``block, ids, sums``.

    ``k`` is ``kernel`` of a tile of squared distances (the distances themselves without one), ``own`` and ``other`` are the arrays ``extra`` of its
    rows and of its columns; the result has a row (of any width) for each row of the tile. A kernel may give several tiles, stacked. A tile
    serves the points of both sides and is dropped: nothing of size n x n is stored or sent. ``block`` is the number of points of a full block.
    """
    def side(table):
        table = table.sort_by("block").combine_chunks()
        ids = table.column("ids").combine_chunks()
        if table.column("values").null_count:
            raise ValueError("a point has no vector")
        sizes = np.diff(ids.offsets.to_numpy()) if len(ids) else np.empty(0, np.int64)
        n = int(sizes.sum())
        values, carried = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("values", "extra"))
        return table.column("block"), ids, sizes, values.astype(np.float64, copy=False), carried

    def out(blocks, ids, sizes, sums):
        width = sums.shape[1]
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes) * width]), pa.int32())
        return pa.table({"block": blocks, "ids": ids, "sums": pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))})

    def run(table: pa.Table) -> pa.Table:
        same = table.column("gi")[0].as_py() == table.column("gj")[0].as_py()
        sides = [side(table.filter(table.column("left")))]
        if not same:
            sides.append(side(table.filter(pc.invert(table.column("left")))))
        (_, _, _, x, ex), (_, _, _, y, ey) = sides[0], sides[-1]
        high = min(len(x), 256)
        wide = max(1, HELD // high)
        sums = [None] * len(sides)

        def add(k, at, part):
            if sums[k] is None:
                sums[k] = np.zeros((len(sides[k][3]), part.shape[1]))
            sums[k][at: at + len(part)] += part

        for i in range(0, len(x), high):
            rows = slice(i, i + high)
            if same:  # the square on the diagonal, then what lies right of it
                square = squared_distances(x[rows], x[rows])
                add(0, i, rows_of(kernel(square) if kernel else square, ex[rows], ex[rows]))
            for j in range(i + high if same else 0, len(y), wide):
                columns = slice(j, j + wide)
                d2 = squared_distances(x[rows], y[columns])
                k = kernel(d2) if kernel else d2
                add(0, i, rows_of(k, ex[rows], ey[columns]))
                add(len(sides) - 1, j, rows_of(k.swapaxes(-1, -2), ey[columns], ex[rows]))
        return pa.concat_tables([out(s[0], s[1], s[2], v) for s, v in zip(sides, sums)])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": frame["block"][:1], "ids": frame["ids"][:1], "sums": [np.sum(np.stack(frame["sums"]), axis=0)]})

    schema = "block int, ids array<long>, sums array<double>"
    return _paired(points, extra, block).groupBy("gi", "gj").applyInArrow(run, schema).groupBy("block").applyInPandas(add_up, schema)


def _by_point(sums: DataFrame, name: str) -> DataFrame:
    """One number for each point from ``tile_sums`` of width 1."""
    return sums.select(F.explode(F.arrays_zip("ids", "sums")).alias("r")).select(F.col("r.ids").alias("id"), F.col("r.sums").alias(name))


def _mean_and_spread(points: DataFrame) -> tuple[np.ndarray, float, int]:
    """The mean vector, the mean squared distance from it, and the number of points; the driver sees one vector."""
    def sums(of):
        def run(frames):
            total, n = 0.0, 0
            for f in frames:
                for ids, values in zip(f["ids"], f["values"]):
                    total, n = total + of(values.reshape(len(ids), -1)), n + len(ids)
            if n:
                yield pd.DataFrame({"s": [np.append(total, float(n))]})

        rows = points.select("ids", "values").mapInPandas(run, "s array<double>").select(F.posexplode("s").alias("k", "v"))
        return np.array([r.v for r in rows.groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()])

    found = sums(lambda x: x.sum(axis=0))
    if not len(found):
        return np.empty(0), 0.0, 0
    mean = found[:-1] / found[-1]
    square, n = sums(lambda x: np.array([((x - mean) ** 2).sum()]))
    return mean, float(square / n), int(n)


def _row_means(points: DataFrame, sigma: float | None, block: int) -> DataFrame:
    """The means of ``row_means`` by block: ``block, ids, sums``.

    The mean squared distance of a point to all is its squared distance to the mean vector and the mean one of all points to it,
    so without a kernel no pair is formed.
    """
    schema = "block int, ids array<long>, sums array<double>"
    if sigma is None:
        mean, spread, _ = _mean_and_spread(points)

        def run(frames):
            for f in frames:
                rows = [((v.reshape(len(i), -1) - mean) ** 2).sum(axis=1) + spread for i, v in zip(f["ids"], f["values"])]
                yield pd.DataFrame({"block": f["block"], "ids": f["ids"], "sums": rows})

        return points.select("block", "ids", "values").mapInPandas(run, schema)
    n = points.agg(F.sum(F.size("ids"))).first()[0] or 1
    ones = points.withColumn("one", F.transform("ids", lambda _: F.lit(1.0)))
    sums = tile_sums(ones, "one", lambda k, _, other: k @ other, lambda d2: np.exp(-d2 / sigma**2), block)
    return sums.withColumn("sums", F.transform("sums", lambda s: s / n))


def row_means(df: DataFrame, id: str, vec: str, sigma: float | None = None, block: int = BLOCK) -> DataFrame:
    """Mean of each row of the matrix of squared distances, or of the RBF kernel of width ``sigma``: ``id, row_mean``."""
    return _by_point(_row_means(stored(point_blocks(df, id, vec, block), "points"), sigma, block), "row_mean")


def centred_energy(df: DataFrame, id: str, vec: str, sigma: float, block: int = BLOCK) -> DataFrame:
    """Sum of squares of each row of the centred RBF kernel: ``id, energy``; the means travel with the points."""
    points = stored(point_blocks(df, id, vec, block), "points")
    means = stored(_row_means(points, sigma, block).select("block", F.col("sums").alias("m")), "means")
    grand = means.select(F.explode("m").alias("m")).agg(F.avg("m")).first()[0]
    sums = tile_sums(points.join(means, "block"), "m", lambda k, own, other: ((k - own - other.T + grand) ** 2).sum(1)[:, None],
                     lambda d2: np.exp(-d2 / sigma**2), block)
    return _by_point(sums, "energy")


def _map_q(frame: DataFrame, change, inputs: list[str]) -> DataFrame:
    """block, ids, q from the arrays ``inputs`` of a block, given as (widths, points, columns)."""
    def run(frames):
        for f in frames:
            yield pd.DataFrame({"block": f["block"], "ids": f["ids"], "q": [change(len(i), *v).ravel() for i, *v in zip(f["ids"], *[f[c] for c in inputs])]})

    return frame.select("block", "ids", *inputs).mapInPandas(run, "block int, ids array<long>, q array<double>")


def _joint_gram(frames: list[DataFrame], widths: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Products of all columns of the given frames with each other and column sums, by width; small matrices that reach the driver."""
    joined = frames[0].select("block", F.size("ids").alias("n"), F.col("q").alias("q0"))
    for k, frame in enumerate(frames[1:], 1):
        joined = joined.join(frame.select("block", F.col("q").alias(f"q{k}")), "block")
    names = [f"q{k}" for k in range(len(frames))]

    def partial(batches):
        total = sums = None
        points = 0
        for f in batches:
            for n, *qs in zip(f["n"], *[f[c] for c in names]):
                points += n
                w = np.concatenate([q.reshape(widths, n, -1) for q in qs], axis=2)
                g, s = w.transpose(0, 2, 1) @ w, w.sum(axis=1)
                total, sums = (g, s) if total is None else (total + g, sums + s)
        if total is not None:
            yield pd.DataFrame({"g": [np.concatenate([total.ravel(), sums.ravel(), [float(points)]])]})

    rows = joined.select("n", *names).mapInPandas(partial, "g array<double>").select(F.posexplode("g").alias("k", "v"))
    with tidy_shuffles(joined.sparkSession):
        found = np.array([r.v for r in rows.groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()])
    count, found = int(found[-1]), found[:-1]
    columns = int(round((-1 + np.sqrt(1 + 4 * len(found) / widths)) / 2))
    return found[: widths * columns**2].reshape(widths, columns, columns), found[widths * columns**2:].reshape(widths, columns), count


#: Part of a column's square outside the spans from which on it is the difference of two products; less is measured on the columns themselves.
CANCELLED = 1e-8


def _orthonormal(raw: DataFrame, spans: list[DataFrame], widths: int, again: bool = False) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The columns less their means and their share in the orthonormal ``spans``, made orthonormal.

    Returns the frame, the shares C and R with ``centred raw = spans C + frame R``, by width. Of columns that lie nearly whole in
    the spans the rest is formed first and then taken in turn, so R is right however small it is against C.
    """
    g, sums, n = _joint_gram([*spans, raw], widths)
    p = g.shape[1] // (len(spans) + 1)
    m = len(spans) * p
    mean = sums[:, m:] / n
    share = g[:, :m, m:] - n * (sums[:, :m] / n)[:, :, None] * mean[:, None, :]
    left = g[:, m:, m:] - n * mean[:, :, None] * mean[:, None, :]
    size = np.sqrt(np.maximum(np.diagonal(left, axis1=1, axis2=2), 0.0))
    size = np.where(size > 0, size, 1.0)
    left = (left - share.transpose(0, 2, 1) @ g[:, :m, :m] @ share) / size[:, :, None] / size[:, None, :]
    cancelled = bool(spans) and not again and np.linalg.eigvalsh((left + left.transpose(0, 2, 1)) / 2).min() <= CANCELLED
    if not cancelled:
        r = np.stack([_factor(a) for a in left]) * size[:, None, :]
        inverse = np.linalg.inv(r)
    joined = raw.withColumnRenamed("q", "raw")
    for k, span in enumerate(spans):
        joined = joined.join(span.select("block", F.col("q").alias(f"q{k}")), "block")

    def change(points, new, *blocks):
        rest = new.reshape(widths, points, -1) - mean[:, None, :]
        if blocks:
            rest = rest - np.concatenate([b.reshape(widths, points, -1) for b in blocks], axis=2) @ share
        return rest if cancelled else rest @ inverse

    changed = stored(_map_q(joined, change, ["raw", *[f"q{k}" for k in range(len(spans))]]), "columns")
    if not cancelled:
        return changed, share, r
    frame, more, r = _orthonormal(changed, spans, widths, True)
    discard(changed)
    return frame, share + more, r


def _factor(g: np.ndarray) -> np.ndarray:
    """Upper R with ``R'R = g`` but for directions that are zero; columns behind ``g`` had length 1."""
    values, basis = np.linalg.eigh((g + g.T) / 2)
    lifted = basis * np.maximum(values, 1e-12) @ basis.T
    return np.linalg.cholesky((lifted + lifted.T) / 2).T


def kernel_times(points: DataFrame, q: DataFrame, sigmas: list[float], block: int = BLOCK) -> DataFrame:
    """The RBF kernel of each width times that width's columns ``q``; all widths share a tile's distances."""
    def kernel(d2):
        out = np.empty((len(sigmas), *d2.shape))
        for tile, sigma in zip(out, sigmas):
            np.exp(np.multiply(d2, -1 / sigma**2, out=tile), out=tile)
        return out

    def rows_of(k, _, other):
        return np.concatenate([tile @ part for tile, part in zip(k, np.split(other, len(sigmas), axis=1))], axis=1)

    # Beside the points the columns of all widths lie side by side: (points, widths x columns).
    flat = _map_q(q, lambda size, v: v.reshape(len(sigmas), size, -1).transpose(1, 0, 2), ["q"])
    sums = tile_sums(points.join(flat.select("block", "q"), "block"), "q", rows_of, kernel, block).withColumnRenamed("sums", "s")
    return stored(_map_q(sums, lambda size, v: v.reshape(size, len(sigmas), -1).transpose(1, 0, 2), ["s"]), "product")


def _image(shares: list[np.ndarray], r: list[np.ndarray]) -> np.ndarray:
    """The kernel times each block by blocks: those up to k times the share of block k, and block k + 1 times its R."""
    p = len(r[0])
    image = np.zeros(((len(r) + 1) * p, len(r) * p))
    for k, (share, factor) in enumerate(zip(shares, r)):
        image[: (k + 1) * p, k * p: (k + 1) * p] = share
        image[(k + 1) * p: (k + 2) * p, k * p: (k + 1) * p] = factor
    return image


def _expected_rest(shares: list[np.ndarray], r: list[np.ndarray], d: int) -> float:
    """What a product would leave of the best ``d`` vectors in the span of the first blocks, were all blocks orthonormal."""
    image = _image(shares, r)
    m = image.shape[1]
    _, u = np.linalg.eigh((image[:m] + image[:m].T) / 2)
    return float(np.linalg.norm(image[m:] @ u[:, ::-1][:, :d], axis=0).max())


def _ritz(g: np.ndarray, shares: list[np.ndarray], r: list[np.ndarray], d: int) -> np.ndarray:
    """Coefficients of the best ``d`` vectors in the span of the first blocks, from products of all blocks."""
    m = len(r) * len(r[0])
    image = _image(shares, r)
    scale, basis = np.linalg.eigh(g[:m, :m])
    keep = scale > 1e-6 * scale[-1]
    white = basis[:, keep] / np.sqrt(scale[keep])
    inner = white.T @ (g[:m] @ image) @ white
    _, u = np.linalg.eigh((inner + inner.T) / 2)
    best = (white @ u)[:, ::-1][:, :d]
    return np.pad(best, ((0, 0), (0, d - best.shape[1])))  # a column that the span cannot fill stays zero


def kernel_pca(df: DataFrame, id: str, vec: str, sigmas: list[float], d: int, tol: float = 1e-3, cycles: int = 100, steps: int = 9, extra: int = 16,
               block: int = BLOCK, seed: int = 0) -> list[tuple[list[float], DataFrame]]:
    """For each width the leading ``d`` eigenvalues of the centred RBF kernel and a frame ``id, component``.

    A restarted block Lanczos iteration on ``d + extra`` columns: a cycle multiplies ``steps`` times or until its span should hold them, keeps the columns orthogonal and takes the
    best vectors of their span. It ends when every ``|K q - value q|`` is at most ``tol`` (q of length 1), which the next product tells. Centring is a
    correction of the columns, not of the kernel; tiles are computed, multiplied and dropped. The driver sees matrices of (steps + 1) * (d + extra) columns.
    """
    points = stored(point_blocks(df, id, vec, block), "points")
    n = points.agg(F.sum(F.size("ids"))).first()[0] or 0
    if n <= d:
        raise ValueError(f"{n} points have fewer than {d} components")
    wide, widths = min(d + extra, n - 1), len(sigmas)
    steps = max(1, min(steps, (n - 1) // wide - 1))
    number = F.flatten(F.transform("ids", lambda i: F.array(*[hash_unit(seed, F.lit(c), i) for c in range(wide)])))
    raw = stored(points.select("block", "ids", F.flatten(F.array_repeat(number, widths)).alias("q")), "start")
    first = None
    for _ in range(cycles):
        if first is not None:
            discard(first)
        first, _, _ = _orthonormal(raw, [], widths)
        discard(raw)
        spans, shares, factors = [first], [], []
        for step in range(steps):
            product = kernel_times(points, spans[-1], sigmas, block)
            q, share, r = _orthonormal(product, spans, widths)
            discard(product)
            spans.append(q)
            shares.append(share)
            factors.append(r)
            if step == 0:  # what the product leaves outside the columns themselves
                values = np.stack([np.diag(c) for c in share])
                inside = share - values[:, None, :] * np.eye(wide)
                rest = np.sqrt((inside**2).sum(axis=1) + (r**2).sum(axis=1))[:, :d]
                if rest.max() <= tol:
                    break
            elif max(_expected_rest([c[s] for c in shares], [f[s] for f in factors], d) for s in range(widths)) <= tol / 2:
                break  # the next product tells
        if rest.max() <= tol:
            break
        g, _, _ = _joint_gram(spans, widths)
        mix = np.stack([_ritz(g[s], [c[s] for c in shares], [r[s] for r in factors], wide) for s in range(widths)])
        joined = spans[0].withColumnRenamed("q", "q0")
        for k, span in enumerate(spans[1:-1], 1):
            joined = joined.join(span.select("block", F.col("q").alias(f"q{k}")), "block")

        def combined(size, *blocks, mix=mix):
            return np.concatenate([b.reshape(widths, size, -1) for b in blocks], axis=2) @ mix

        raw = stored(_map_q(joined, combined, [f"q{k}" for k in range(len(spans) - 1)]), "best")
        for span in spans[1:]:
            discard(span)
        spans = [first]
    for frame in [points, raw, *spans[1:]]:  # the columns of the first block are the result
        discard(frame)
    out = []
    for s in range(widths):
        start = F.lit(s) * F.size("ids") * wide
        rows = first.select(F.posexplode("ids").alias("p", "id"), start.alias("start"), "q")
        out.append((values[s, :d].tolist(), rows.select("id", F.slice("q", F.col("start") + F.col("p") * wide + 1, d).alias("component"))))
    return out


def residuals(df: DataFrame, id: str, vec: str, sigma: float, values: list[float], components: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each component its length, its mean and ``|K q - value q|`` by one more product with the centred kernel.

    Rows of one id are taken as copies of a point, each with one of the id's rows of ``components``.
    """
    points = stored(point_blocks(df, id, vec, block), "points")
    d = len(values)
    places = points.select("block", "ids", F.posexplode("ids").alias("p", "id")).withColumn("copy", F.row_number().over(Window.partitionBy("id").orderBy("block", "p")))
    given = components.select(F.col("id").alias("of"), "component", F.row_number().over(Window.partitionBy("id").orderBy("component")).alias("number"))
    q = places.join(given, F.col("id").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("number"))).groupBy("block").agg(
        F.first("ids").alias("ids"), F.flatten(F.sort_array(F.collect_list(F.struct("p", "component")))["component"]).alias("q"))  # a block has a fixed size
    q = stored(q, "components")
    image = kernel_times(points, q, [sigma], block)
    lam = np.array(values)
    joined = image.withColumnRenamed("q", "image").join(q.select("block", "q"), "block")
    left = stored(_map_q(joined, lambda size, image, q: image.reshape(size, -1) - lam * q.reshape(size, -1), ["image", "q"]), "left")
    g, sums, n = _joint_gram([q, left], 1)
    for frame in (points, q, image, left):
        discard(frame)
    mean = sums[0] / n
    g = g[0] - n * np.outer(mean, mean)
    own, rest = np.diag(g)[:d], np.sqrt(np.maximum(np.diag(g)[d:], 0.0))
    rows = [(k, float(lam[k]), float(np.sqrt(own[k])), float(mean[k]), float(rest[k])) for k in range(d)]
    return df.sparkSession.createDataFrame(rows, "k int, value double, length double, mean double, residual double")
