"""Column functions, one query per kind."""

from pyspark.sql import functions as F

from tidewright.functions import (
    argmax_position,
    central_bounds,
    channel_scale,
    compact_date,
    distance,
    dot,
    due_by,
    epoch_seconds,
    expanded_sq_distance,
    fill_placeholders,
    folder_up,
    grid_box,
    join_key,
    linspace,
    log_mean_exp,
    lonlat_cell,
    pack_boxes,
    permute_axes,
    rbf,
    shortest_side,
    squared_distance,
    status_code,
    strip_home,
    time_parts,
    typed_literal,
)
from tidewright.operators.raster import grid_cells
from tidewright.queries.fixtures import annotations, image_files, images, model_scores, rounded, series, table, vectors, with_
from tidewright.queries.registry import query


@query("""SELECT event_id, CAST(day(ts) AS SMALLINT) AS day, CAST(hour(ts) AS SMALLINT) AS hour, CAST(minute(ts) AS SMALLINT) AS minute,
    epoch_us(ts) // 1000000 AS epochtime, user_id || '_' || event_type AS key FROM events""")
def time_parts_and_keys(spark, folder):
    events = table(spark, folder, "events").withColumns(time_parts("ts"))
    return events.select("event_id", "day", "hour", "minute", epoch_seconds(F.col("ts")).alias("epochtime"), join_key("user_id", "event_type").alias("key"))


@query(with_("image_files", """SELECT img_id, split_part(img_path, '/', 5) AS pad, strftime(strptime(split_part(img_path, '/', 3), '%Y%m%d'), '%Y-%m-%d') AS week,
    substr(img_path, 6) AS short, replace(replace(img_path, 'img', 'photo'), 'obs', 'seen') AS renamed FROM image_files"""))
def path_parts(spark, folder):
    return image_files(spark, folder).select(
        "img_id", folder_up("img_path", 1).alias("pad"), compact_date(folder_up("img_path", 3)).alias("week"),
        strip_home("img_path", "/obs").alias("short"), fill_placeholders("img_path", {"img": "photo", "obs": "seen"}).alias("renamed"),
    )


@query("""SELECT o_orderkey, (o_orderdate + to_days(CAST(o_custkey % 30 AS INTEGER)) <= TIMESTAMP '1998-06-01') AS due,
    o_orderstatus = '' AS blank FROM orders""")
def interval_tests(spark, folder):
    return table(spark, folder, "orders").withColumn("days", F.col("o_custkey") % 30).select(
        "o_orderkey", due_by("o_orderdate", "days", F.lit("1998-06-01").cast("timestamp_ntz")).alias("due"),
        (F.col("o_orderstatus") == typed_literal(None)).alias("blank"),
    )


@query(with_("annotations images", """, scaled AS (SELECT img_id, truth_id, x * 224 / width AS a, (x + w) * 224 / width AS b, y * 224 / height AS c, (y + h) * 224 / height AS d
      FROM annotations JOIN images USING (img_id))
    SELECT img_id, truth_id, CAST(least(greatest(floor((floor(a) + 1 + 8) / 16.0), 1), 13) - 1 AS INTEGER) AS x0,
      CAST(least(greatest(floor((floor(c) + 1 + 8) / 16.0), 1), 13) - 1 AS INTEGER) AS y0,
      CAST(least(greatest(floor((ceil(b) + 1 + 8) / 16.0), 1), 13) AS INTEGER) AS x1,
      CAST(least(greatest(floor((ceil(d) + 1 + 8) / 16.0), 1), 13) AS INTEGER) AS y1 FROM scaled"""))
def boxes_on_grid(spark, folder):
    joined = annotations(spark, folder).join(images(spark, folder), "img_id")
    return joined.select("img_id", "truth_id", grid_box("bbox", "width", "height").alias("g")).select("img_id", "truth_id", "g.*")


@query("""SELECT event_id, round(100.0 - (value - 500) / (-500.0) * 100, 6) AS x, round(value / 2 / 500.0 * 100, 6) AS y FROM events""")
def places_on_raster(spark, folder):
    cell = lonlat_cell("value", F.col("value") / 2, F.lit(0.0), F.lit(500.0), F.lit(500.0), F.lit(0.0))
    return table(spark, folder, "events").select("event_id", cell.alias("p")).select("event_id", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query(with_("images", """SELECT img_id, CAST(trunc(height * (256.0::FLOAT::DOUBLE / least(height, width))) AS INTEGER) AS new_height,
    CAST(trunc(width * (256.0::FLOAT::DOUBLE / least(height, width))) AS INTEGER) AS new_width,
    CAST(floor((width - width * 0.875) / 2) AS BIGINT) AS crop_first, CAST(width - floor((width - width * 0.875) / 2) AS BIGINT) AS crop_last,
    CAST(floor((height - 224) / 2.0) AS BIGINT) AS fixed_first FROM images"""))
def resized_and_cropped(spark, folder):
    size = shortest_side("height", "width", 256)
    crop, fixed = central_bounds("width", fraction=0.875), central_bounds("height", size=224)
    return images(spark, folder).select(
        "img_id", size["height"].alias("new_height"), size["width"].alias("new_width"), crop["first"].alias("crop_first"),
        crop["last"].alias("crop_last"), fixed["first"].alias("fixed_first"),
    )


@query(with_("series", "SELECT event_id, cloud * 10 + CAST(value <> 0 AS INTEGER) AS code FROM series"))
def status_codes(spark, folder):
    return series(spark, folder).select("event_id", status_code("cloud", "value").alias("code"))


@query("""SELECT a.vec_id, round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS dist,
    round(pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2), 9) AS d2,
    round(exp(-pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2) / 4), 9) AS k
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def distance_to_next_vector(spark, folder):
    v = vectors(spark, folder).drop("label")
    pairs = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec").alias("other")), "vec_id")
    d2 = expanded_sq_distance(dot("vec", "vec"), dot("other", "other"), dot("vec", "other"))
    return rounded(pairs.select(
        "vec_id", distance("vec", "other").alias("dist"), d2.alias("d2"), rbf(squared_distance("vec", "other"), 2.0).alias("k")
    ), 9)


@query("""SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best,
    round(list_sum(list_transform(embedding, lambda v: ((CAST(v AS DOUBLE) - 0.485) / 0.229))), 6) AS total FROM embeddings""")
def scaled_channels(spark, folder):
    scaled = channel_scale("vec", 0.485, 0.229)
    return rounded(vectors(spark, folder).select(
        "vec_id", argmax_position("vec").cast("long").alias("best"), F.aggregate(scaled, F.lit(0.0), lambda a, v: a + v).alias("total")
    ))


@query(with_("model_scores", "SELECT row_id, round(ln(avg(p)), 9) AS log_p FROM model_scores GROUP BY row_id"))
def log_mean_of_scores(spark, folder):
    logs = model_scores(spark, folder).groupBy("row_id").agg(F.collect_list(F.log(F.col("probs")[1])).alias("l"))
    return rounded(logs.select("row_id", log_mean_exp("l").alias("log_p")), 9)


@query("""SELECT vec_id, list_transform(range(len(embedding)), lambda i: [embedding[i + 1], embedding[len(embedding) - i], embedding[i + 1] + 1, embedding[len(embedding) - i] + 2]) AS boxes FROM embeddings""")
def packed_boxes(spark, folder):
    sides = vectors(spark, folder).select(
        "vec_id", F.col("vec").alias("ymin"), F.reverse("vec").alias("xmin"),
        F.transform("vec", lambda v: v + F.lit(1.0).cast("float")).alias("ymax"), F.transform(F.reverse("vec"), lambda v: v + F.lit(2.0).cast("float")).alias("xmax"),
    )
    return sides.select("vec_id", pack_boxes("ymin", "xmin", "ymax", "xmax").alias("boxes"))


@query("""SELECT vec_id, CAST((i - 1) // 8 AS INTEGER) AS x, CAST((i - 1) % 8 AS INTEGER) AS y, v AS value
    FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)""")
def transposed_grid(spark, folder):
    return permute_axes(grid_cells(vectors(spark, folder), "vec", 8, ["vec_id"]), {"x": "y", "y": "x"})


@query("""SELECT o_orderkey, round(10 + i * 40.0::DOUBLE / 4, 9) AS sigma FROM orders, range(5) t(i)""")
def evenly_spaced(spark, folder):
    return rounded(table(spark, folder, "orders").select("o_orderkey", F.explode(linspace(10, 50, 5)).alias("sigma")), 9)
