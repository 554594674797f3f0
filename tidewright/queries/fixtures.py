"""Operator inputs derived from the given tables, in Spark and in SQL.

Each Spark function has the SQL of the same relation in ``CTE``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
CLASSES = ["bear", "bird", "cat", "cow"]
LABELS = list(range(10))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clicks(spark, folder) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("click_id"),
        F.col("user_id").alias("ip"),
        F.array_position(F.lit(EVENT_TYPES), F.col("event_type")).cast("int").alias("app"),
        (F.col("event_id") % 3).cast("int").alias("device"),
        (k % 5).alias("os"),
        (k % 11).alias("channel"),
        F.col("ts").alias("click_time"),
        (F.col("event_type") == "purchase").cast("int").alias("is_attributed"),
    )


def policy(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_linenumber as ps_ind_03", "cast(l_quantity as int) as ps_ind_15",
        "cast(l_linestatus = 'O' as int) as ps_ind_06_bin",
        "l_discount as ps_reg_01", "l_tax as ps_reg_02", "l_extendedprice / 1000 as ps_reg_03",
        "l_quantity / 10 as ps_car_13",
        "cast(l_suppkey % 5 as int) as ps_car_01_cat", "cast(l_partkey % 3 as int) as ps_car_04_cat",
        "cast(l_partkey % 2 as int) as ps_car_08_cat",
        "l_linenumber % 3 as ps_calc_01", "cast(l_quantity as int) % 3 as ps_calc_02", "cast(l_partkey % 3 as int) as ps_calc_03",
        "l_linenumber % 2 as ps_calc_15_bin", "cast(l_suppkey % 2 as int) as ps_calc_16_bin", "cast(l_quantity as int) % 2 as ps_calc_17_bin",
        "cast(l_returnflag = 'R' as int) as target",
    )


def annotations(spark, folder) -> DataFrame:
    """One image per order; its lineitems are annotated boxes."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey as img_id",
        "l_linenumber * 100000000000000 + l_partkey * 100000000 + l_suppkey * 100 + cast(l_quantity as bigint) as truth_id",
        "l_linenumber * 100000000000000 + l_partkey * 100000000 + l_suppkey * 100 + cast(l_quantity as bigint) as position",
        "element_at(array('bear', 'bird', 'cat', 'cow'), cast(l_suppkey % 4 + 1 as int)) as class_name",
        """named_struct('x', cast(l_partkey % 40 * 4 as double), 'y', cast(l_suppkey % 10 * 16 as double),
             'w', 40 + l_quantity, 'h', cast(60 + l_partkey % 7 * 5 as double)) as bbox""",
    )


def boxes(spark, folder) -> DataFrame:
    """The annotations, shifted."""
    return annotations(spark, folder).selectExpr(
        "img_id", "truth_id as box_id", "class_name",
        """named_struct('x', bbox.x + truth_id % 3 * 6, 'y', bbox.y + truth_id % 5 * 3, 'w', bbox.w, 'h', bbox.h) as bbox""",
    )


def detections(spark, folder) -> DataFrame:
    """The shifted boxes with a score."""
    return boxes(spark, folder).selectExpr(
        "img_id", "class_name", "box_id as det_id", "(box_id % 1009 * 7919 % 1009) / 1009.0D as score", "bbox"
    )


def images(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as img_id", "cast(200 + o_orderkey % 5 * 50 as int) as width", "cast(240 + o_orderkey % 3 * 40 as int) as height"
    )


def series(spark, folder) -> DataFrame:
    """One series per user; errors are clouds and high values are water."""
    return table(spark, folder, "events").selectExpr(
        "user_id as series_id", "ts", "event_id", "value", "cast(event_type = 'error' as int) as cloud", "cast(value > 40 as int) as water"
    )


def vectors(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").selectExpr("vec_id", "embedding as vec", "label")


def image_files(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as img_id",
        "concat('/obs/', date_format(o_orderdate, 'yyyyMMdd'), '/b/', o_custkey, '/img', o_orderkey, '.tif') as img_path",
    )


def model_scores(spark, folder) -> DataFrame:
    """Three estimators' class probabilities for each order, in 1024ths so that sums are exact."""
    p = [f"(o_orderkey * {a} % 1023 + 1) / 1024.0D" for a in (7, 31, 101)]
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as row_id",
        f"explode(array(named_struct('estimator', 0, 'p', {p[0]}), named_struct('estimator', 1, 'p', {p[1]}), named_struct('estimator', 2, 'p', {p[2]}))) as s",
    ).selectExpr("row_id", "s.estimator", "array(1 - s.p, s.p) as probs")


# Hash planes both engines can compute: 4 tables of 6 projections in 64 dimensions.
TABLES, PLANES, DIM, RADIUS = 4, 6, 64, 0.6


def planes() -> np.ndarray:
    t, p, i = np.meshgrid(np.arange(TABLES), np.arange(PLANES), np.arange(DIM), indexing="ij")
    return ((t * 7919 + p * 104729 + i * 1299709 + t * p * i * 31) % 1009 - 504) / 2520.0


CTE = {
    "clicks": """clicks AS (SELECT event_id AS click_id, user_id AS ip,
        CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS INTEGER) AS app,
        CAST(event_id % 3 AS INTEGER) AS device,
        CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 5 AS os,
        CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 11 AS channel,
        ts AS click_time, CAST(event_type = 'purchase' AS INTEGER) AS is_attributed FROM events)""",
    "policy": """policy AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        l_linenumber AS ps_ind_03, CAST(l_quantity AS INTEGER) AS ps_ind_15, CAST(l_linestatus = 'O' AS INTEGER) AS ps_ind_06_bin,
        l_discount AS ps_reg_01, l_tax AS ps_reg_02, l_extendedprice / 1000 AS ps_reg_03, l_quantity / 10 AS ps_car_13,
        CAST(l_suppkey % 5 AS INTEGER) AS ps_car_01_cat, CAST(l_partkey % 3 AS INTEGER) AS ps_car_04_cat,
        CAST(l_partkey % 2 AS INTEGER) AS ps_car_08_cat,
        l_linenumber % 3 AS ps_calc_01, CAST(l_quantity AS INTEGER) % 3 AS ps_calc_02, CAST(l_partkey % 3 AS INTEGER) AS ps_calc_03,
        l_linenumber % 2 AS ps_calc_15_bin, CAST(l_suppkey % 2 AS INTEGER) AS ps_calc_16_bin, CAST(l_quantity AS INTEGER) % 2 AS ps_calc_17_bin,
        CAST(l_returnflag = 'R' AS INTEGER) AS target FROM lineitem)""",
    "annotations": """annotations AS (SELECT l_orderkey AS img_id,
        l_linenumber * 100000000000000 + l_partkey * 100000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS truth_id,
        ['bear', 'bird', 'cat', 'cow'][l_suppkey % 4 + 1] AS class_name,
        CAST(l_partkey % 40 * 4 AS DOUBLE) AS x, CAST(l_suppkey % 10 * 16 AS DOUBLE) AS y,
        40 + l_quantity AS w, CAST(60 + l_partkey % 7 * 5 AS DOUBLE) AS h FROM lineitem)""",
    "boxes": """boxes AS (SELECT img_id, truth_id AS box_id, class_name,
        x + truth_id % 3 * 6 AS x, y + truth_id % 5 * 3 AS y, w, h FROM annotations)""",
    "detections": """detections AS (SELECT img_id, class_name, box_id AS det_id, (box_id * 7919 % 1009) / 1009.0::DOUBLE AS score, x, y, w, h FROM boxes)""",
    "pairs": """crossing AS (SELECT b.img_id, b.box_id, t.truth_id, t.class_name,
            greatest(b.x, t.x) AS x0, least(b.x + b.w, t.x + t.w) AS x1, greatest(b.y, t.y) AS y0, least(b.y + b.h, t.y + t.h) AS y1,
            (b.w + 1) * (b.h + 1) + (t.w + 1) * (t.h + 1) AS areas
        FROM boxes b JOIN annotations t ON b.img_id = t.img_id),
        pairs AS (SELECT img_id, box_id, truth_id, class_name,
            (x1 - x0 + 1) * (y1 - y0 + 1) / (areas - (x1 - x0 + 1) * (y1 - y0 + 1)) AS iou
        FROM crossing WHERE x1 >= x0 AND y1 >= y0)""",
    "images": """images AS (SELECT o_orderkey AS img_id, CAST(200 + o_orderkey % 5 * 50 AS INTEGER) AS width,
        CAST(240 + o_orderkey % 3 * 40 AS INTEGER) AS height FROM orders)""",
    "series": """series AS (SELECT user_id AS series_id, ts, event_id, value, CAST(event_type = 'error' AS INTEGER) AS cloud,
        CAST(value > 40 AS INTEGER) AS water FROM events)""",
    "image_files": """image_files AS (SELECT o_orderkey AS img_id,
        '/obs/' || strftime(o_orderdate, '%Y%m%d') || '/b/' || o_custkey || '/img' || o_orderkey || '.tif' AS img_path FROM orders)""",
    "model_scores": """model_scores AS (
        SELECT o_orderkey AS row_id, 0 AS estimator, (o_orderkey * 7 % 1023 + 1) / 1024.0::DOUBLE AS p FROM orders UNION ALL
        SELECT o_orderkey, 1, (o_orderkey * 31 % 1023 + 1) / 1024.0::DOUBLE FROM orders UNION ALL
        SELECT o_orderkey, 2, (o_orderkey * 101 % 1023 + 1) / 1024.0::DOUBLE FROM orders)""",
    "buckets": f"""planes AS (SELECT t, p, list_transform(range({DIM}), lambda i:
            ((t * 7919 + p * 104729 + i * 1299709 + t * p * i * 31) % 1009 - 504) / 2520.0::DOUBLE) AS plane
        FROM range({TABLES}) a(t), range({PLANES}) b(p)),
        projected AS (SELECT vec_id, label, t, p,
            CAST(floor(list_inner_product(CAST(embedding AS DOUBLE[]), plane) / {2 * RADIUS}) AS BIGINT) AS n
        FROM embeddings, planes),
        buckets AS (SELECT vec_id, t AS table_id, list(n ORDER BY p) AS bucket FROM projected GROUP BY vec_id, t)""",
}


def with_(names: str, body: str) -> str:
    """SQL that starts with the named relations."""
    return "WITH " + ",\n".join(CTE[n] for n in names.split()) + "\n" + body


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, since engines may add in another order."""
    return df.select(*[
        F.round(n, digits).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes
    ])
