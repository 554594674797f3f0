"""Boxes against annotations, grids and pooling."""

from pyspark.sql import functions as F

from tidewright.operators.boxes import (
    box_label,
    box_label_matrix,
    box_pairs,
    boxes_per_image,
    detection_map,
    detection_map_set,
    match_boxes,
    nms,
)
from tidewright.operators.order import row_index
from tidewright.operators.raster import box_features, central_crop, global_avg, grid_cells, max_around, max_filter, pyramid_pool
from tidewright.queries.fixtures import CLASSES, annotations, boxes, detections, images, rounded, vectors, with_
from tidewright.queries.registry import query

_BASE = "annotations boxes pairs"


@query(with_(_BASE, "SELECT DISTINCT img_id, round(iou, 9) AS iou, bx, bh, tx, th FROM (SELECT p.img_id, p.iou, b.x AS bx, b.h AS bh, t.x AS tx, t.h AS th FROM pairs p "
             "JOIN boxes b ON p.img_id = b.img_id AND p.box_id = b.box_id JOIN annotations t ON p.img_id = t.img_id AND p.truth_id = t.truth_id) WHERE iou >= 0.3"))
def overlapping_pairs(spark, folder):
    pairs = box_pairs(boxes(spark, folder), annotations(spark, folder), min_iou=0.3)
    return rounded(pairs.select("img_id", "iou", F.col("box.x").alias("bx"), F.col("box.h").alias("bh"), F.col("truth.x").alias("tx"), F.col("truth.h").alias("th")).distinct(), 9)


@query(with_(_BASE, """, hits AS (SELECT img_id, box_id, """ + ", ".join(
        f"max(CASE WHEN class_name = '{c}' THEN 1 ELSE 0 END) AS label_{c}" for c in CLASSES)
    + """ FROM pairs WHERE iou >= 0.5 GROUP BY img_id, box_id)
    SELECT b.img_id, b.box_id, """ + ", ".join(f"CAST(coalesce(label_{c}, 0) AS INTEGER) AS label_{c}" for c in CLASSES)
    + " FROM boxes b LEFT JOIN hits h ON b.img_id = h.img_id AND b.box_id = h.box_id"))
def box_label_columns(spark, folder):
    return box_label_matrix(boxes(spark, folder), annotations(spark, folder), CLASSES)


@query(with_(_BASE, """, first AS (SELECT img_id, class_name, min(truth_id) AS pos FROM annotations GROUP BY ALL),
    met AS (SELECT img_id, box_id, arg_min(class_name, pos) AS class_name FROM pairs JOIN first USING (img_id, class_name) WHERE iou > 0.5 GROUP BY img_id, box_id)
    SELECT b.img_id, b.box_id, coalesce(m.class_name, 'background') AS class_name FROM boxes b LEFT JOIN met m
    ON b.img_id = m.img_id AND b.box_id = m.box_id"""))
def box_classes(spark, folder):
    return box_label(boxes(spark, folder), annotations(spark, folder))


@query(with_("annotations images", "SELECT i.img_id, count(a.img_id) AS n_boxes FROM images i LEFT JOIN annotations a ON i.img_id = a.img_id GROUP BY i.img_id"))
def boxes_of_images(spark, folder):
    return boxes_per_image(images(spark, folder), annotations(spark, folder))


@query(with_(_BASE, """, own AS (SELECT img_id, box_id, truth_id, iou, false AS forced FROM pairs WHERE iou >= 0.5
      QUALIFY row_number() OVER (PARTITION BY img_id, box_id ORDER BY iou DESC, truth_id) = 1),
    claim AS (SELECT img_id, box_id, truth_id, iou, true AS forced FROM pairs QUALIFY row_number() OVER (PARTITION BY img_id, truth_id ORDER BY iou DESC, box_id) = 1),
    both_ AS (SELECT * FROM own UNION ALL SELECT * FROM claim)
    SELECT img_id, box_id, truth_id, round(iou, 9) AS iou, forced FROM both_
    QUALIFY row_number() OVER (PARTITION BY img_id, box_id ORDER BY forced DESC, iou DESC, truth_id) = 1"""))
def matched_boxes(spark, folder):
    return rounded(match_boxes(boxes(spark, folder), annotations(spark, folder)), 9)


@query()
def suppressed_detections(spark, folder):
    return nms(detections(spark, folder), 0.6, 100, 100)


@query()
def detection_average_precision(spark, folder):
    return detection_map(detections(spark, folder), annotations(spark, folder))


@query()
def detection_map_by_limit(spark, folder):
    return detection_map_set(detections(spark, folder), annotations(spark, folder))


_CELLS = """cells AS (SELECT vec_id, CAST((i - 1) % 8 AS INTEGER) AS x, CAST((i - 1) // 8 AS INTEGER) AS y, v AS value
    FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings))"""


def _cells(spark, folder):
    return grid_cells(vectors(spark, folder), "vec", 8, ["vec_id"])


@query(f"WITH {_CELLS} SELECT vec_id, max(value) AS value FROM cells WHERE x BETWEEN 2 AND 4 AND y BETWEEN 3 AND 5 GROUP BY vec_id")
def maximum_around_place(spark, folder):
    return max_around(_cells(spark, folder), 4, 3, by=["vec_id"])


@query(f"WITH {_CELLS} SELECT a.vec_id, a.x, a.y, max(b.value) AS value FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY ALL")
def maximum_around_every_cell(spark, folder):
    return max_filter(_cells(spark, folder), 1, ["vec_id"])


@query("SELECT vec_id, round(list_avg(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 9) AS value FROM embeddings")
def pooled_average(spark, folder):
    return rounded(global_avg(_cells(spark, folder), ["vec_id"]), 9)


@query(f"WITH {_CELLS} SELECT vec_id, x, y, value FROM cells WHERE x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6")
def central_cells(spark, folder):
    return central_crop(_cells(spark, folder), 8, 0.75)


def _grids(spark, folder):
    return vectors(spark, folder).select(F.col("vec_id").alias("img_id"), F.lit(0).alias("channel"), F.col("vec").alias("values"), F.lit(8).alias("side"))


_PLACED = """placed AS (SELECT vec_id, CAST(vec_id % 3 AS INTEGER) AS x0, CAST(vec_id % 2 AS INTEGER) AS y0, CAST(5 + vec_id % 4 AS INTEGER) AS x1, CAST(6 + vec_id % 3 AS INTEGER) AS y1 FROM embeddings)"""


@query(f"""WITH {_PLACED}, cells AS (SELECT vec_id, (i - 1) // 8 AS x, (i - 1) % 8 AS y, v FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)),
    bins AS (SELECT n, i, j FROM (VALUES (1), (3), (6)) s(n), range(6) a(i), range(6) b(j) WHERE i < n AND j < n),
    pooled AS (SELECT vec_id, n, i, j, max(v) AS m FROM placed JOIN cells USING (vec_id), bins
      WHERE x >= x0 + floor(i * (x1 - x0) / CAST(n AS DOUBLE)) AND x < x0 + ceil((i + 1) * (x1 - x0) / CAST(n AS DOUBLE))
        AND y >= y0 + floor(j * (y1 - y0) / CAST(n AS DOUBLE)) AND y < y0 + ceil((j + 1) * (y1 - y0) / CAST(n AS DOUBLE)) GROUP BY ALL)
    SELECT vec_id AS img_id, list(m ORDER BY i, j) FILTER (WHERE n = 1) AS pool_1, list(m ORDER BY i, j) FILTER (WHERE n = 3) AS pool_3,
      list(m ORDER BY i, j) FILTER (WHERE n = 6) AS pool_6 FROM pooled GROUP BY vec_id""")
def pyramid_of_boxes(spark, folder):
    placed = vectors(spark, folder).selectExpr(
        "vec_id as img_id", "vec_id as box_id",
        "named_struct('x0', cast(vec_id % 3 as int), 'y0', cast(vec_id % 2 as int), 'x1', cast(5 + vec_id % 4 as int), 'y1', cast(6 + vec_id % 3 as int)) as grid",
    )
    return pyramid_pool(_grids(spark, folder), placed, columns=False).select("img_id", "pool_1", "pool_3", "pool_6")


@query()
def box_feature_arrays(spark, folder):
    """All boxes, on an 8 x 8 grid of 28-pixel steps; image i takes the grid at place i modulo their number."""
    placed = row_index(_grids(spark, folder).withColumnRenamed("img_id", "vec_id"), "vec_id", "place")
    shown = images(spark, folder)
    taken = shown.select("img_id", F.pmod("img_id", F.lit(placed.count())).alias("place"))
    return box_features(taken.join(placed, "place").drop("place", "vec_id"), boxes(spark, folder), shown, cells=8, stride=28)
