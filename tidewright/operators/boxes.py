"""Boxes against annotations: overlap join, labels, matching, suppression and mAP.

Equal boxes of an image are joined once, and boxes meet only in the grid cells
they share, so a crowded image is spread over many keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.order import prefix_sums
from tidewright.session import cut, stored

# Side of a grid cell in pixels, a few times a usual box: smaller cells copy a box
# more often, larger ones compare more boxes of a crowded image.
CELL = 256.0


SIDES = ("x", "y", "w", "h")


def _flat(df: DataFrame, side: str, image: str, *cols) -> DataFrame:
    """Box coordinates as plain columns ``a_x`` .. ``a_h``: cheaper join keys than a struct."""
    return df.select(image, *[F.col(f"bbox.{n}").cast("double").alias(f"{side}_{n}") for n in SIDES], *cols)


def _on(side: str, image: str) -> list[str]:
    return [image, *[f"{side}_{n}" for n in SIDES]]


def _cells(plain: DataFrame, side: str, cell: float) -> DataFrame:
    """Flat boxes, one row for each grid cell they touch."""
    x, y, w, h = (F.col(f"{side}_{n}") for n in SIDES)
    across = plain.select("*", F.explode(F.sequence(F.floor(x / cell), F.floor((x + w) / cell))).alias("_cx"))
    return across.select("*", F.explode(F.sequence(F.floor(y / cell), F.floor((y + h) / cell))).alias("_cy"))


def _pairs(boxes: DataFrame, truth: DataFrame, on: list[str], min_iou: float, cell: float = CELL) -> DataFrame:
    """Overlapping pairs of flat boxes ``a_*`` and ``b_*`` with equal ``on``, with their IoU.

    Each side has a box once for each ``on``; what else it carries (ids, counts) goes along, so nothing is joined back.
    """
    joined = _cells(boxes, "a", cell).join(_cells(truth, "b", cell), [*on, "_cx", "_cy"])
    ax, ay, aw, ah = (F.col(f"a_{n}") for n in SIDES)
    bx, by, bw, bh = (F.col(f"b_{n}") for n in SIDES)
    x0, y0 = F.greatest(ax, bx), F.greatest(ay, by)
    x1, y1 = F.least(ax + aw, bx + bw), F.least(ay + ah, by + bh)
    here = (F.floor(x0 / cell) == F.col("_cx")) & (F.floor(y0 / cell) == F.col("_cy"))
    areas = [(aw + 1) * (ah + 1), (bw + 1) * (bh + 1)]
    joined = joined.filter((x1 >= x0) & (y1 >= y0) & here)
    if min_iou > 0:
        joined = joined.filter(F.least(*areas) >= min_iou * (1 - 1e-9) * F.greatest(*areas))
    inter = (x1 - x0 + 1) * (y1 - y0 + 1)
    iou = F.try_divide(inter, areas[0] + areas[1] - inter)  # Spark may compute it before the filters, where the divisor can be 0
    return joined.filter(iou >= min_iou).drop("_cx", "_cy").withColumn("iou", iou)


def box_pairs(boxes: DataFrame, truth: DataFrame, image: str = "img_id", min_iou: float = 0.0, cell: float = CELL) -> DataFrame:
    """Pairs of a box and an annotation of the same image that overlap, with their IoU.

    Each pair is reported only by the cell that holds the top-left corner of the
    overlap. With ``min_iou`` boxes of too different area are left out before
    the IoU is computed. Columns: image, ``box``, ``truth``, ``iou``.
    """
    def packed(side, name):
        return F.struct(*[F.col(f"{side}_{n}").alias(n) for n in SIDES]).alias(name)

    sides = [_flat(df, side, image).distinct() for df, side in ((boxes, "a"), (truth, "b"))]
    return _pairs(*sides, [image], min_iou, cell).select(image, packed("a", "box"), packed("b", "truth"), "iou")


def _class_pairs(boxes, truth, image, iou, strict):
    """Pairs with each class that is annotated at the place, equal annotations counted once."""
    groups = _flat(truth, "b", image, "class_name").groupBy(*_on("b", image), "class_name").agg(F.count(F.lit(1)).alias("copies"))
    pairs = _pairs(_flat(boxes, "a", image).distinct(), groups, [image], iou)
    return pairs.filter(F.col("iou") > iou) if strict else pairs


def box_label_matrix(boxes: DataFrame, truth: DataFrame, classes, iou: float = 0.5, capped: bool = True,
                     image: str = "img_id") -> DataFrame:
    """One 0/1 column per class: does the box meet an annotation of it (count when not capped)?"""
    hits = _class_pairs(boxes, truth, image, iou, False).groupBy(*_on("a", image)).agg(
        *[F.sum(F.when(F.col("class_name") == F.lit(c), F.col("copies"))).alias(f"_{i}") for i, c in enumerate(classes)]
    )
    joined = _flat(boxes, "a", image, "box_id").join(hits, _on("a", image), "left")
    value = [F.coalesce(F.col(f"_{i}"), F.lit(0)) for i in range(len(classes))]
    return joined.select(image, "box_id", *[
        (F.least(v, F.lit(1)) if capped else v).cast("int").alias(f"label_{c}") for v, c in zip(value, classes)
    ])


def box_label(boxes: DataFrame, truth: DataFrame, iou: float = 0.5, strict: bool = True,
              background: str = "background", image: str = "img_id") -> DataFrame:
    """Class of each box: of the classes met above ``iou``, the one annotated first in its image."""
    order = truth.groupBy(image, "class_name").agg(F.min("position").alias("class_pos"))
    met = _class_pairs(boxes, truth, image, iou, strict).join(order, [image, "class_name"])
    first = met.groupBy(*_on("a", image)).agg(F.min(F.struct("class_pos", "class_name")).alias("_first"))
    joined = _flat(boxes, "a", image, "box_id").join(first, _on("a", image), "left")
    return joined.select(image, "box_id", F.coalesce("_first.class_name", F.lit(background)).alias("class_name"))


def boxes_per_image(images: DataFrame, boxes: DataFrame, image: str = "img_id") -> DataFrame:
    """Number of boxes of each image, 0 without any."""
    counts = boxes.groupBy(image).agg(F.count(F.lit(1)).alias("n"))
    return images.select(image).join(counts, image, "left").select(image, F.coalesce("n", F.lit(0)).alias("n_boxes"))


def match_boxes(anchors: DataFrame, truth: DataFrame, iou: float = 0.5, force: bool = True, image: str = "img_id") -> DataFrame:
    """Annotation matched to each box.

    A box takes its best annotation at or above ``iou``; with ``force`` each
    annotation also claims its best overlapping box whatever the IoU, and this
    claim wins. Ties go to the smaller id. ``best`` aggregates combine before
    the shuffle.
    """
    a = _flat(anchors, "a", image, "box_id")
    t = _flat(truth, "b", image, "truth_id")
    first_truth = t.groupBy(*_on("b", image)).agg(F.min("truth_id").alias("truth_id"))
    first_box = a.groupBy(*_on("a", image)).agg(F.min("box_id").alias("box_id"))
    pairs = _pairs(first_box, first_truth, [image], 0.0 if force else iou)
    if force:
        pairs = stored(pairs, "pairs")  # read twice: once per box, once per annotation
    own = (
        pairs.filter(F.col("iou") >= iou)
        .groupBy(*_on("a", image)).agg(F.max(F.struct("iou", (-F.col("truth_id")).alias("n"))).alias("_b"))
    )
    chosen = own.join(a, _on("a", image)).select(
        image, "box_id", (-F.col("_b.n")).alias("truth_id"), F.col("_b.iou").alias("iou"), F.lit(False).alias("forced")
    )
    if not force:
        return chosen
    claim = (
        pairs.groupBy(*_on("b", image)).agg(F.max(F.struct("iou", (-F.col("box_id")).alias("n"))).alias("_b"))
        .join(t, _on("b", image))
        .select(image, (-F.col("_b.n")).alias("box_id"), "truth_id", F.col("_b.iou").alias("iou"), F.lit(True).alias("forced"))
    )
    both = chosen.unionByName(claim)
    best = both.groupBy(image, "box_id").agg(F.max(F.struct("forced", "iou", (-F.col("truth_id")).alias("n"))).alias("_b"))
    return best.select(image, "box_id", (-F.col("_b.n")).alias("truth_id"), F.col("_b.iou").alias("iou"), F.col("_b.forced").alias("forced"))


def _plain_iou(a, b):
    """IoU of plain edges, as detector post-processing uses it (no inclusive pixel)."""
    inter_w = F.greatest(F.lit(0.0), F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"]))
    inter_h = F.greatest(F.lit(0.0), F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"]))
    inter = inter_w * inter_h
    union = a["w"] * a["h"] + b["w"] * b["h"] - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def nms(det: DataFrame, iou: float = 0.6, per_class: int = 100, total: int = 100, score_threshold: float = 0.0,
        image: str = "img_id", cls: str = "class_name", block: int = 1000) -> DataFrame:
    """Greedy non-maximum suppression: per class, then the best of an image.

    The best ``block`` detections of each (image, class) are resolved greedily,
    the rest is tested against what was kept, and what survives is the next
    round's input. A group in a task therefore never exceeds ``block`` rows, and
    since each round keeps at least one box, ``per_class`` rounds are enough.
    Usually the first suffices. ``det`` has det_id, score and bbox.
    """
    rest = cut(det.filter(F.col("score") > score_threshold).select(
        image, cls, "det_id", "score", F.struct(*[F.col(f"bbox.{n}").cast("double").alias(n) for n in "xywh"]).alias("box")
    ))
    best_first = Window.partitionBy(image, cls).orderBy(F.col("score").desc(), "det_id")
    item = F.struct((-F.col("score")).alias("order"), "det_id", "box")
    empty = F.array().cast(f"array<struct<order: double, det_id: {dict(det.dtypes)['det_id']}, box: struct<x: double, y: double, w: double, h: double>>>")

    def add(kept, new):
        clash = F.exists(kept, lambda k: _plain_iou(k["box"], new["box"]) > iou)
        return F.when(clash | (F.size(kept) >= per_class), kept).otherwise(F.array_append(kept, new))

    kept = None
    for _ in range(per_class):
        ranked = rest.withColumn("_rank", F.row_number().over(best_first)).filter(F.col("_rank") <= block)
        groups = ranked.groupBy(image, cls).agg(
            F.sort_array(F.collect_list(item)).alias("_items"), F.count(F.lit(1)).alias("_n")
        )  # at most ``block`` boxes
        resolved = groups.select(
            image, cls, F.aggregate("_items", empty, add).alias("_kept"),
            (F.col("_n") >= block).alias("_more"), F.element_at("_items", -1).alias("_last"),
        )
        if kept is not None:
            resolved = resolved.unionByName(kept.withColumns({"_more": F.lit(False), "_last": F.lit(None).cast(dict(resolved.dtypes)["_last"])}))
        merged = cut(resolved.groupBy(image, cls).agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("_kept"))), 1, per_class).alias("_kept"),
            F.max("_more").alias("_more"), F.max("_last").alias("_last"),
        ))  # one array per round and group
        kept = merged.select(image, cls, "_kept")
        still = merged.filter(F.col("_more") & (F.size("_kept") < per_class))
        if still.isEmpty():
            break
        beyond = (-F.col("score") > F.col("_last.order")) | ((-F.col("score") == F.col("_last.order")) & (F.col("det_id") > F.col("_last.det_id")))
        clear = ~F.exists("_kept", lambda k: _plain_iou(k["box"], F.col("box")) > iou)
        rest = cut(rest.join(still, [image, cls]).filter(beyond & clear).select(*rest.columns))
    rows = kept.select(image, cls, F.explode("_kept").alias("_k")).select(image, cls, "_k.det_id", (-F.col("_k.order")).alias("score"))
    over_all = F.row_number().over(Window.partitionBy(image).orderBy(F.col("score").desc(), cls, "det_id"))
    return rows.withColumn("_rank", over_all).filter(F.col("_rank") <= total).drop("_rank")


def _near_pairs(det: DataFrame, truth: DataFrame, iou: float, per_image: int | None) -> tuple[DataFrame, DataFrame]:
    """The detections of each image and class, and the annotations each of them meets.

    With ``per_image`` only so many of the best count, as in the published metric; then only so many
    annotations of a detection can matter, because fewer detections come before it, and a group has a fixed size.
    """
    group = Window.partitionBy("img_id", "class_name").orderBy(F.col("score").desc(), "det_id")
    best = det
    if per_image is not None:
        best = det.withColumn("_rank", F.row_number().over(group)).filter(F.col("_rank") <= per_image).drop("_rank")
    on = ["img_id", "class_name"]
    dets = _flat(best, "a", "img_id", "class_name", "det_id", "score")
    truths = _flat(truth, "b", "img_id", "class_name", "truth_id")
    places = [side.drop(*ids).distinct() for side, ids in ((dets, ["det_id", "score"]), (truths, ["truth_id"]))]
    met = (
        _pairs(*places, on, iou)
        .join(dets, [*_on("a", "img_id"), "class_name"])
        .join(truths, [*_on("b", "img_id"), "class_name"])
        .select("img_id", "class_name", "det_id", "score", "truth_id", "iou")
    )
    if per_image is None:
        return best, met
    per_det = Window.partitionBy("img_id", "class_name", "det_id").orderBy(F.col("iou").desc(), "truth_id")
    near = met.withColumn("_rank", F.row_number().over(per_det)).filter(F.col("_rank") <= per_image).drop("_rank")
    return best, near


def _assigned(near: DataFrame, limits) -> DataFrame:
    """Detections that get an annotation: by falling score, each takes its best one still free.

    Bit i of ``hits`` stands for the pairs at or above the i-th limit, each limit being assigned by itself.
    """
    item = F.struct((-F.col("score")).alias("order"), "det_id", (-F.col("iou")).alias("iou"), "truth_id")
    kind = dict(near.dtypes)
    start = F.struct(
        F.array().cast(f"array<{kind['det_id']}>").alias("dets"), F.array().cast(f"array<{kind['truth_id']}>").alias("truths")
    )

    def take(state, pair):
        free = ~F.array_contains(state["dets"], pair["det_id"]) & ~F.array_contains(state["truths"], pair["truth_id"])
        taken = F.struct(
            F.array_append(state["dets"], pair["det_id"]).alias("dets"), F.array_append(state["truths"], pair["truth_id"]).alias("truths")
        )
        return F.when(free, taken).otherwise(state)

    def marked(i, limit):
        dets = F.aggregate(F.filter("_p", lambda p: -p["iou"] >= limit), start, take)["dets"]
        return F.transform(dets, lambda d: F.struct(d.alias("det_id"), F.lit(1 << i).alias("bit")))

    groups = near.groupBy("img_id", "class_name").agg(F.sort_array(F.collect_list(item)).alias("_p"))
    found = groups.select("img_id", "class_name", F.explode(F.concat(*[marked(i, v) for i, v in enumerate(limits)])).alias("_d"))
    return found.groupBy("img_id", "class_name", "_d.det_id").agg(F.bit_or("_d.bit").alias("hits"))


def _with_hits(best: DataFrame, near: DataFrame, limits) -> DataFrame:
    joined = best.join(_assigned(near, limits), ["img_id", "class_name", "det_id"], "left")
    return joined.select("img_id", "class_name", "det_id", "score", F.coalesce("hits", F.lit(0)).alias("hits"))


def detection_hits(det: DataFrame, truth: DataFrame, iou: float = 0.5, per_image: int | None = None) -> DataFrame:
    """The detections of each image and class (the best ``per_image``, if given; the published metric takes 100), with 1 for a hit and 0 for a false alarm."""
    hits = _with_hits(*_near_pairs(det, truth, iou, per_image), [iou])
    return hits.withColumnRenamed("hits", "hit")


def _step_precision(hits: DataFrame, truth: DataFrame, limits) -> DataFrame:
    """Average precision by class and limit with recall over all annotations, found or not.

    Detections are counted by class and score for all limits at once, so they are read and ranked once.
    """
    hit = [f"_hit_{i}" for i in range(len(limits))]
    counts = hits.groupBy("class_name", "score").agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col("hits").bitwiseAND(F.lit(1 << i)) != 0).alias(c) for i, c in enumerate(hit)],
    )
    amounts = {"seen": "_all", **{f"tp{c}": c for c in hit}}
    cum = prefix_sums(counts, [F.col("score").desc()], amounts, ["class_name"])
    by_class = cum.groupBy("class_name").agg(F.array(*[
        F.struct(F.lit(float(v)).alias("iou"), F.sum(F.col(c) * (F.col(f"tp{c}") / F.col("seen"))).alias("area"), F.sum(c).alias("hits"))
        for c, v in zip(hit, limits)
    ]).alias("_found"))
    totals = truth.groupBy("class_name").agg(F.count(F.lit(1)).alias("_all"))
    absent = F.array(*[F.struct(F.lit(float(v)).alias("iou"), F.lit(0.0).alias("area"), F.lit(0).cast("long").alias("hits")) for v in limits])
    joined = totals.join(by_class, "class_name", "left")
    rows = joined.select("class_name", "_all", F.explode(F.coalesce("_found", absent)).alias("_f"))
    share = F.col("_f.hits") / F.col("_all")
    ap = F.when(share > 0, F.col("_f.area") / F.col("_f.hits") * share).otherwise(F.lit(0.0))
    return rows.select("class_name", "_f.iou", ap.alias("ap"))


# The ten IoU limits of the detection metric set.
IOU_LIMITS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)


def detection_map(det: DataFrame, truth: DataFrame, iou: float = 0.5, per_image: int | None = None) -> DataFrame:
    """AP of every annotated class at one IoU limit."""
    hits = _with_hits(*_near_pairs(det, truth, iou, per_image), [iou])
    return _step_precision(hits, truth, [iou]).drop("iou")


def detection_map_set(det: DataFrame, truth: DataFrame, limits=IOU_LIMITS, per_image: int | None = None) -> DataFrame:
    """Mean AP at each IoU limit; their mean is the headline figure.

    Pairs are found once for the lowest limit, and a group of them is assigned for all limits where it is.
    """
    hits = _with_hits(*_near_pairs(det, truth, min(limits), per_image), limits)
    aps = _step_precision(hits, truth, limits)
    means = aps.agg(F.array(*[
        F.struct(F.lit(v).alias("iou"), F.avg(F.when(F.col("iou") == v, F.col("ap"))).alias("map")) for v in limits
    ]).alias("_m"))
    return means.select(F.inline("_m"))
