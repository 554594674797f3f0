"""Merkle manifest of a table: a tree for each group of rows, and one over the groups' roots.

Nodes of a level are rows (tree, idx, digest). Every ``fan`` consecutive nodes of a tree form a run, whose last may be
shorter. A level equijoins its nodes with themselves on computed sibling indices: idx XOR 1 for a binary tree, else the
other slots of the run by offset. The rows of slot zero then emit the parents. Levels are written as they come; the
proofs go back down, each node taking its parent's steps behind its own.

All joins are on (tree, idx), which is unique, so a group that holds a third of the rows spreads like any other. Places
within a group come from one range sort and one count for each task and group. The text of a row is read to hash it and
moves nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import store

FAN = 3


def _hex(digest) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests) -> Column:
    """Digests one after another, as hex text."""
    return F.array_join(F.transform(digests, _hex), "")


def field(value: Column) -> Column:
    """A value as ``size:text`` with the UTF-8 bytes of its text, or ``-`` if null: no two rows run into one."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """sha256 of the fields of a row, as binary."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def _indexed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows(tree, ...) with idx, the 0-based place in the tree in the given order, and n, the rows of the tree."""
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    placed = store(rows.orderBy("tree", *order).withColumns({"part": part, "place": place}), "leaves")
    runs = placed.groupBy("part", "tree").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    of_tree = Window.partitionBy("tree")  # one row for each task that holds rows of the tree
    before = F.sum("size").over(of_tree.orderBy("part")) - F.col("size")
    runs = runs.select("part", "tree", (before - F.col("first")).alias("shift"), F.sum("size").over(of_tree).alias("n"))
    return placed.join(runs, ["part", "tree"]).withColumn("idx", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """nodes(tree, idx, n, digest, row) with slot and others, the digests of the rest of the run from left to right."""
    slot = F.col("idx") % fan
    out = nodes.withColumn("slot", slot.cast("int"))
    found = []
    for j in range(1, fan):
        at = (F.col("slot") + j) % fan
        sibling = F.col("idx").bitwiseXOR(F.lit(1)) if fan == 2 else F.col("idx") - F.col("slot") + at
        right = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("digest").alias(f"_digest{j}"))
        out = out.withColumn("_at", sibling).join(right, (F.col("tree") == F.col("_tree")) & (F.col("_at") == F.col("_idx")), "left")
        out = out.drop("_tree", "_idx", "_at")
        found.append(F.struct(at.alias("at"), F.col(f"_digest{j}").alias("digest")))
    present = F.filter(F.array_sort(F.array(*found)), lambda s: s["digest"].isNotNull())
    return out.withColumn("others", F.transform(present, lambda s: s["digest"])).drop(*[f"_digest{j}" for j in range(1, fan)])


def _climb(nodes: DataFrame, fan: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each level its nodes with siblings, and the last nodes of the trees that end on it."""
    levels, ends = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        ends.append(nodes.where("n = 1"))
        if most <= 1:
            return levels, ends
        level = store(_with_siblings(nodes.where("n > 1"), fan), "level")
        levels.append(level)
        digest = F.unhex(F.sha2(F.concat(_hex("digest"), _joined("others")), 256))
        kind = dict(nodes.dtypes)["row"]
        nodes = level.where("slot = 0").select(
            "tree", F.expr(f"idx DIV {fan}").alias("idx"), F.expr(f"(n + {fan - 1}) DIV {fan}").alias("n"), digest.alias("digest"), F.lit(None).cast(kind).alias("row"),
        )
        most = -(-most // fan)


def _descend(levels: list[DataFrame], ends: list[DataFrame], crown: DataFrame, fan: int) -> DataFrame:
    """row, digest, subroot, root, steps for each leaf; crown(tree, subroot, root, steps) has the steps above each tree."""
    columns = ["tree", "idx", "digest", "row", "subroot", "root", "steps"]
    below = ends[-1].join(crown, "tree").select(*columns)
    for level, end in zip(reversed(levels), reversed(ends[:-1])):
        above = store(below.select("tree", F.col("idx").alias("_up"), "subroot", "root", F.col("steps").alias("_steps")), "proofs")
        own = F.array(F.struct("slot", "others"))
        lower = level.withColumn("_up", F.expr(f"idx DIV {fan}")).join(above, ["tree", "_up"])
        lower = lower.withColumn("steps", F.concat(own, "_steps")).select(*columns)
        below = lower.unionByName(end.join(crown, "tree").select(*columns))
    return below.select("row", "digest", "subroot", "root", "steps")


def manifest(leaves: DataFrame, order: list[str], fan: int = FAN) -> DataFrame:
    """All columns of leaves(group, digest, ...) with subroot, root and steps, the proof of the leaf from the bottom up.

    ``group`` is the text or number that names a row's tree (null is a group of its own and the first), ``digest`` the leaf as
    binary; within a group the leaves stand in the given order, ties by digest, and rows that are equal in both are leaves of
    their own. A step is (slot, others): the node's slot in its run and the digests of the run's other nodes. Groups are ordered
    by their UTF-8 bytes. A lone leaf is its group's subroot, a lone subroot the root. An empty table gives no rows. Other
    columns are carried along under any name but subroot, root and steps.
    """
    carried = F.struct(*[F.col(c) for c in leaves.columns]).alias("row")
    tree = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit(""))
    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(order)]
    rows = leaves.select(tree.alias("tree"), "digest", carried, *keys)
    nodes = _indexed(rows, [*[f"_by{i}" for i in range(len(order))], "digest"]).select("tree", "idx", "n", "digest", "row")
    levels, ends = _climb(nodes, fan)
    subroots = ends[0].select("tree", "digest")
    for end in ends[1:]:
        subroots = subroots.unionByName(end.select("tree", "digest"))
    tops = _indexed(subroots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("row")), ["row"]).select("tree", "idx", "n", "digest", "row")
    top_levels, top_ends = _climb(tops, fan)
    none = F.array().cast("array<struct<slot:int,others:array<binary>>>")
    root = top_ends[-1].select("tree", F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"), none.alias("steps"))
    crown = _descend(top_levels, top_ends, root, fan).select(F.col("row").alias("tree"), F.col("digest").alias("subroot"), "root", "steps")
    return _descend(levels, ends, store(crown, "subroots"), fan).select("row.*", "subroot", "root", "steps")


def proof(steps="steps") -> Column:
    """The siblings of all steps, bottom up and left to right, as hex texts."""
    return F.flatten(F.transform(steps, lambda s: F.transform(s["others"], _hex)))


def folded(digest, steps="steps") -> Column:
    """The root, as hex text, that a leaf's digest (binary) and its steps lead to."""
    def up(below, step):
        left, right = F.slice(step["others"], F.lit(1), step["slot"]), F.slice(step["others"], step["slot"] + 1, F.size(step["others"]))
        return F.sha2(F.concat(_joined(left), below, _joined(right)), 256)

    return F.aggregate(steps, _hex(digest), up)
