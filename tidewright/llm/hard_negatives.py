"""Hard negatives by a cover tree over norm-augmented vectors.

Every vector gets one more coordinate that makes all norms equal, so that the inner product with an anchor falls as the
distance to it grows, and a ball around a tree node bounds the products of all vectors in it from both sides. The tree's
top level is fitted on a bounded sample: the cells around its centres, with covering radii from all rows. A cell is
split by a hash of the id into groups of bounded size, however many copies of one vector it holds, and each group is
built into a tree of its own by one task: farthest-first centres on each level (no two closer than the level's covering radius),
down to leaves of a few rows.

Anchors search by groups. First each looks into its own group, which gives its windows a floor; then it goes to those
cells whose balls reach into a window. A task descends its tree best first for a block of anchors: the node with the
highest bound is next, nodes outside the windows or below the k best so far are skipped, and leaves are verified exactly on
integers. What the tasks find is ranked per anchor and window by a window function that keeps k rows a task before it shuffles.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import store

#: Rows of a group, about; a group's tree is built and searched in one task.
GROUP_ROWS = 4096
#: Rows on which the cells are fitted; also the greatest number of cells.
SAMPLE_ROWS = 2048
#: Anchors that one task takes to one group.
WAVE_ANCHORS = 65_536
#: Anchors that descend together, children of a node, and rows of a leaf.
BLOCK, FAN, LEAF = 256, 8, 128
#: Components beyond this limit count as the limit, so that scores stay within a long.
LIMIT = 1 << 27
_FAR = 1 << 62


def integer_vector(vec, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(vec, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))


def usable(label, vec) -> Column:
    """Whether a row has a label and a vector without null or non-finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(label).isNotNull() & F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one counts as followed by zeros."""
    out = np.zeros((len(vectors), width), np.int32)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def augmented(points: np.ndarray, top: float) -> np.ndarray:
    """Points with a coordinate more, all of squared norm ``top``."""
    points = points.astype(np.float64)
    rest = np.sqrt(np.maximum(0.0, top - (points * points).sum(axis=1)))
    return np.column_stack([points, rest])


def farthest_first(points: np.ndarray, first: int, count: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """At most ``count`` centres, each the point farthest from those before; the nearest centre of each point and its distance."""
    centres, owner = [first], np.zeros(len(points), np.int64)
    near = np.linalg.norm(points - points[first], axis=1)
    while len(centres) < count:
        new = int(near.argmax())
        if near[new] == 0:
            break
        dist = np.linalg.norm(points - points[new], axis=1)
        closer = dist < near
        owner[closer], near = len(centres), np.where(closer, dist, near)
        owner[new], near[new] = len(centres), 0.0
        centres.append(new)
    return centres, owner, near


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of a cover tree: (centre, begin, end, is leaf), covering radii, and the order of the points.

    ``begin`` and ``end`` limit a leaf's rows in the order, else the node's children. Nodes stand level by level, the root
    first. A node without extent is a leaf whatever its rows.
    """
    start = int(np.linalg.norm(points - points.mean(axis=0), axis=1).argmin())
    radius = float(np.linalg.norm(points - points[start], axis=1).max())
    nodes, radii, members, order, at = [[start, 0, 0, 0]], [radius], [np.arange(len(points))], [], 0
    while at < len(nodes):
        rows, centre = members[at], nodes[at][0]
        members[at] = None
        if len(rows) <= LEAF or radii[at] == 0:
            nodes[at] = [centre, len(order), len(order) + len(rows), 1]
            order.extend(rows.tolist())
        else:
            inside = points[rows]
            centres, owner, near = farthest_first(inside, int(np.flatnonzero(rows == centre)[0]), FAN)
            nodes[at] = [centre, len(nodes), len(nodes) + len(centres), 0]
            for c, p in enumerate(centres):
                mine = owner == c
                nodes.append([int(rows[p]), 0, 0, 0])
                radii.append(float(near[mine].max()))
                members.append(rows[mine])
        at += 1
    return np.array(nodes, np.int64), np.array(radii), np.array(order, np.int64)


def _bounds(products, norms, radii, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner products in balls, from the products (anchors x balls) with their centres."""
    square = (norms * norms)[:, None] + top
    dist = np.sqrt(np.maximum(0.0, square - 2 * products))
    slack = 1e-6 * (1 + norms[:, None] * np.sqrt(top))
    high = np.minimum((square - np.maximum(0.0, dist - radii) ** 2) / 2, products + norms[:, None] * radii)
    low = np.maximum((square - (dist + radii) ** 2) / 2, products - norms[:, None] * radii)
    return low - slack, high + slack


def _reaches(low, high, floor, ceiling) -> np.ndarray:
    """Whether an anchor's bounds (anchors x balls) meet one of its windows (anchors x windows)."""
    return ((high[:, :, None] >= floor[:, None, :]) & (low[:, :, None] <= ceiling[:, None, :])).any(axis=2)


class Best:
    """The k highest scores of each anchor and window (ties: smaller id), and the floor that they set."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k, self.parts, self.waiting = floor.copy(), k, [], 0

    def add(self, anchor, window, score, ids) -> None:
        self.parts.append((anchor, window, score, ids))
        self.waiting += len(ids)
        if self.waiting > 2 * self.floor.size * self.k:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 4
        anchor, window, score, ids = (np.concatenate(p) for p in zip(*self.parts))
        order = np.lexsort((ids, -score, window, anchor))
        key = (anchor * self.floor.shape[1] + window)[order]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rank = np.arange(len(key)) - np.repeat(begins, np.diff(np.r_[begins, len(key)]))
        order, rank = order[rank < self.k], rank[rank < self.k]
        kept = tuple(v[order] for v in (anchor, window, score, ids))
        last = rank == self.k - 1
        self.floor[kept[0][last], kept[1][last]] = np.maximum(self.floor[kept[0][last], kept[1][last]], kept[2][last])
        self.parts, self.waiting = [kept], 0
        return kept


def search(anchors: dict, tree: dict, same: bool, k: int, top: float) -> tuple[np.ndarray, ...]:
    """The k best rows of a tree in each window of a block of anchors, as (anchor number, window, score, id).

    anchors: ids, labels, vecs, floor and ceiling (anchors x windows, both included); tree: ids, labels and vecs in the tree's
    order, nodes, radii, centres. ``same`` asks for rows of the anchor's label, else for rows of other labels; a row with the anchor's id never counts.
    """
    exact = float(np.abs(anchors["vecs"]).max(initial=0)) * float(np.abs(tree["vecs"]).max(initial=0)) * tree["vecs"].shape[1] < 2**52
    kind = np.float64 if exact else np.int64
    vecs = anchors["vecs"].astype(kind)
    norms = np.linalg.norm(anchors["vecs"].astype(np.float64), axis=1)
    low, high = _bounds(vecs.astype(np.float64) @ tree["centres"].T.astype(np.float64), norms, tree["radii"], top)
    best, ceiling = Best(anchors["floor"], k), anchors["ceiling"]
    heap = [(-float(high[:, 0].max(initial=0.0)), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        at = np.flatnonzero(_reaches(low[:, node: node + 1], high[:, node: node + 1], best.floor, ceiling)[:, 0])
        if not len(at):
            continue
        _, begin, end, leaf = tree["nodes"][node]
        if not leaf:
            for child in range(begin, end):
                heapq.heappush(heap, (-float(high[at, child].max()), child))
            continue
        score = (vecs[at] @ tree["vecs"][begin:end].T.astype(kind)).astype(np.int64)
        ids = tree["ids"][begin:end]
        fits = ((anchors["labels"][at, None] == tree["labels"][None, begin:end]) == same) & (anchors["ids"][at, None] != ids[None, :])
        inside = fits[:, None, :] & (score[:, None, :] >= best.floor[at][:, :, None]) & (score[:, None, :] <= ceiling[at][:, :, None])
        anchor, window, row = np.nonzero(inside)
        if len(row):
            best.add(at[anchor], window, score[anchor, row], ids[row])
    return best.settle()


def _array(blob: bytes, kind, width: int | None = None) -> np.ndarray:
    out = np.frombuffer(blob, kind)
    return out if width is None else out.reshape(-1, width)


class CoverTreeIndex:
    """Groups of rows (id, label, vec), each with a cover tree, below the cells of a sample.

    ``rows`` has id long, label long, vec array<int>. Rows without an id take no part; of rows with one id the least (label, vec) counts.
    """

    def __init__(self, rows: DataFrame, group_rows: int = GROUP_ROWS):
        one = rows.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "vec")).alias("r"))
        points = store(one.select("id", "r.label", "r.vec"), "points")
        norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        count, top, width = points.agg(F.count("*"), F.max(norm), F.max(F.size("vec"))).first()
        self.count, self.top, self.width = count, float(top or 0.0), int(width or 0)
        self._fit_cells(points, group_rows)
        self.points = self._grouped(points, group_rows)
        self.trees = store(self._build(), "trees")

    def _fit_cells(self, points: DataFrame, group_rows: int) -> None:
        sample = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vec").collect()
        fitted = augmented(_matrix([r.vec for r in sample], self.width), self.top)
        wanted = max(1, -(-self.count // group_rows))
        chosen = farthest_first(fitted, 0, wanted)[0] if len(fitted) else []
        self.centres = fitted[chosen]

    def _grouped(self, points: DataFrame, group_rows: int) -> DataFrame:
        """The rows with ``grp``; notes each cell's covering radius and first group."""
        centres, top, width = self.centres, self.top, self.width

        def nearest(frames):
            for frame in frames:
                at = augmented(_matrix(frame["vec"], width), top)
                cell, dist = np.zeros(len(at), np.int32), np.full(len(at), np.inf)
                for c in range(len(centres)):
                    d = np.linalg.norm(at - centres[c], axis=1)
                    cell, dist = np.where(d < dist, np.int32(c), cell), np.minimum(d, dist)
                yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "vec": frame["vec"], "cell": cell, "dist": dist})

        placed = store(points.mapInPandas(nearest, "id long, label long, vec array<int>, cell int, dist double"), "cells")
        found = {r.cell: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).collect()}  # SAMPLE_ROWS at most
        sizes = [-(-found[c].n // (2 * group_rows)) if c in found else 0 for c in range(len(centres))]
        self.radii = np.array([found[c].radius if c in found else 0.0 for c in range(len(centres))])
        self.first = np.cumsum([0, *sizes])
        cells = [(c, int(self.first[c]), int(sizes[c])) for c in range(len(centres)) if sizes[c]]
        known = placed.sparkSession.createDataFrame(cells, "cell int, first long, parts long")
        grp = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))
        return placed.join(F.broadcast(known), "cell").select("id", "label", "vec", grp.alias("grp"))

    def _build(self) -> DataFrame:
        top, width = self.top, self.width

        def build(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("id")
            vecs = _matrix(frame["vec"].to_numpy(), width)
            nodes, radii, order = cover_tree(augmented(vecs, top))
            return pd.DataFrame({
                "grp": [frame["grp"].iloc[0]], "ids": [frame["id"].to_numpy(np.int64)[order].tobytes()],
                "labels": [frame["label"].to_numpy(np.int64)[order].tobytes()], "vecs": [vecs[order].tobytes()], "nodes": [nodes.tobytes()],
                "radii": [radii.tobytes()], "centres": [vecs[nodes[:, 0]].tobytes()],
            })

        schema = "grp long, ids binary, labels binary, vecs binary, nodes binary, radii binary, centres binary"
        return self.points.groupBy("grp").applyInPandas(build, schema)

    def _found(self, anchors: DataFrame, same: bool, k: int, own: bool) -> DataFrame:
        """anchor, window, score, id: the k best of each window, from the anchors' own groups or from all that reach into a window."""
        centres, radii, first, top, width = self.centres, self.radii, self.first, self.top, self.width
        waves = max(1, -(-anchors.count() // WAVE_ANCHORS))

        def send(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            grp = int(frame["grp"].iloc[0])
            frame = frame.sort_values("id")
            for begin in range(0, len(frame), BLOCK):
                part = frame.iloc[begin: begin + BLOCK]
                windows = max(1, part["floor"].map(len).max())
                floor, ceiling = np.full((len(part), windows), _FAR), np.full((len(part), windows), -_FAR)
                for i, (a, b) in enumerate(zip(part["floor"], part["ceiling"])):
                    floor[i, : len(a)], ceiling[i, : len(b)] = a, b
                vecs, ids, labels = _matrix(part["vec"].to_numpy(), width), part["id"].to_numpy(np.int64), part["label"].to_numpy(np.int64)
                if own:
                    targets = [(np.arange(len(part)), [grp])]
                else:
                    at = vecs.astype(np.float64)
                    low, high = _bounds(at @ centres[:, :-1].T, np.linalg.norm(at, axis=1), radii, top)
                    reach = _reaches(low, high, floor, ceiling)
                    targets = [(np.flatnonzero(reach[:, c]), range(first[c], first[c + 1])) for c in range(len(centres))]
                for rows, groups in targets:
                    if len(rows):
                        packed = [v[rows].tobytes() for v in (ids, labels, vecs, floor, ceiling)]
                        out += [(int(g), (grp + begin // BLOCK) % waves, windows, *packed) for g in groups]
            return pd.DataFrame(out, columns=["target", "wave", "windows", "ids", "labels", "vecs", "floor", "ceiling"])

        tiles = anchors.groupBy("grp").applyInPandas(
            send, "target long, wave int, windows int, ids binary, labels binary, vecs binary, floor binary, ceiling binary")

        def visit(blocks: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(trees) and len(blocks):
                t = trees.iloc[0]
                tree = {
                    "ids": _array(t["ids"], np.int64), "labels": _array(t["labels"], np.int64), "vecs": _array(t["vecs"], np.int32).reshape(-1, width),
                    "nodes": _array(t["nodes"], np.int64, 4), "radii": _array(t["radii"], np.float64),
                }
                tree["centres"] = _array(t["centres"], np.int32).reshape(len(tree["nodes"]), width)
                for b in blocks.itertuples(index=False):
                    ids = _array(b.ids, np.int64)
                    block = {
                        "ids": ids, "labels": _array(b.labels, np.int64), "vecs": _array(b.vecs, np.int32).reshape(len(ids), width),
                        "floor": _array(b.floor, np.int64, b.windows), "ceiling": _array(b.ceiling, np.int64, b.windows),
                    }
                    anchor, window, score, found = search(block, tree, same, k, top)
                    out.append(pd.DataFrame({"anchor": ids[anchor], "window": window.astype(np.int32), "score": score, "id": found}))
            return pd.concat(out) if out else pd.DataFrame({"anchor": [], "window": [], "score": [], "id": []})

        copies = self.trees.withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1)))).withColumnRenamed("grp", "target")
        met = tiles.groupBy("target", "wave").cogroup(copies.groupBy("target", "wave"))
        hits = met.applyInPandas(visit, "anchor long, window int, score long, id long")
        best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
        return store(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "found")

    def best_in_windows(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """anchor, window, score, id, rank: the k best rows in each window of anchors(id, label, vec, grp, floor, ceiling).

        The windows of an anchor are the pairs of its arrays ``floor`` and ``ceiling``, both included. The own group comes first; the k-th
        score found there is a floor for all others.
        """
        anchors = store(anchors, "anchors")
        near = self._found(anchors, same, k, own=True).where(F.col("rank") == k)
        floors = near.groupBy(F.col("anchor").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("_known"))
        raised = F.transform("floor", lambda v, i: F.coalesce(F.try_element_at("_known", i), v))
        return self._found(anchors.join(floors, "id", "left").withColumn("floor", raised).drop("_known"), same, k, own=False)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows(id long, label long, vec array<int>) as ``CoverTreeIndex`` takes them; ``anchor`` is a condition on them. An anchor's positives are
    the ``positives`` best other rows of its label; for each of these come the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score, ranked from 1. Scores are inner products, ties go to the smaller
    id. Fewer rows come out where fewer exist, none from an empty table.
    """
    index = CoverTreeIndex(rows, group_rows)
    anchors = index.points.where(anchor)
    all_scores = [F.array(F.lit(v).cast("long")).alias(n) for n, v in (("floor", -_FAR), ("ceiling", _FAR))]
    found = index.best_in_windows(anchors.select("*", *all_scores), True, positives)
    score = F.col("score")
    # 100 s >= low * p and 100 s <= high * p on whole numbers
    windows = F.struct("rank", (-F.floor(-score * low / F.lit(100).cast("decimal(3,0)"))).cast("long").alias("floor"),
                       F.floor(score * high / F.lit(100).cast("decimal(3,0)")).cast("long").alias("ceiling"))
    per_anchor = found.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(windows)).alias("_windows"))  # ``positives`` at most
    asked = anchors.join(per_anchor, "id").select("id", "label", "vec", "grp", F.col("_windows.floor").alias("floor"), F.col("_windows.ceiling").alias("ceiling"))
    hard = index.best_in_windows(asked, False, negatives)
    positive = found.select(F.col("anchor"), (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(positive, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
