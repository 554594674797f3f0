"""Joins, filters, sets and sources."""

from pyspark.sql import functions as F

from tidewright.functions.text import non_blank_text
from tidewright.operators.joins import (
    dense_position,
    distinct_keys,
    for_each_param,
    glue,
    holdout,
    inner_on,
    lookup,
    new_only,
    one_per,
    pending,
    pending_staged,
    stack,
    unseen,
)
from tidewright.operators.select import (
    add_products,
    argmax_index,
    assign_bucket,
    clip,
    cols_like,
    column_roles,
    drop_cols,
    drop_incomplete,
    expm1_clip,
    good_images,
    label_positions,
    non_blank,
    only_table,
    predictors,
    sample_fraction,
    to_numeric,
    valid_coords,
    whitelist,
)
from tidewright.plans.image_labels import labelled_images
from tidewright.queries.fixtures import image_files, policy, rounded, table, vectors, with_
from tidewright.queries.registry import query
from tidewright.session import scratch_path
from tidewright.sources.records import label_columns, read_features, write_features
from tidewright.sources.text_files import CLICK_SCHEMA, scan_csv, submission, write_csv
from tidewright.queries.fixtures import clicks

_TRACKING = """tracking AS (SELECT o_orderkey AS load_id, CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE '/in/' || o_custkey || '.csv' END AS file_location,
      o_orderpriority AS destination_table, o_orderdate AS date_created FROM orders),
    status AS (SELECT o_orderkey AS load_id, CASE WHEN o_orderstatus = 'F' THEN 'loaded' ELSE 'failed' END AS action_type FROM orders)"""


def _tracking(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as load_id", "case when o_orderkey % 9 = 0 then '  ' else concat('/in/', o_custkey, '.csv') end as file_location",
        "o_orderpriority as destination_table", "o_orderdate as date_created",
    )


def _status(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as load_id", "case when o_orderstatus = 'F' then 'loaded' else 'failed' end as action_type"
    )


def _staged(spark, folder):
    return table(spark, folder, "customer").selectExpr("concat('/in/', c_custkey + c_custkey % 3 * 1000000, '.csv') as file_location", "c_mktsegment as destination_table")


_STAGED = "staged AS (SELECT '/in/' || (c_custkey + c_custkey % 3 * 1000000) || '.csv' AS file_location, c_mktsegment AS destination_table FROM customer)"


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey")
def part_and_supplier_of_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return inner_on(inner_on(lines, part, "l_partkey"), supplier, "l_suppkey")


@query("""WITH a AS (SELECT user_id, event_type, round(avg(value), 6) AS mean FROM events GROUP BY ALL),
    b AS (SELECT user_id, event_type, max(value) AS top FROM events WHERE value > 20 GROUP BY ALL)
    SELECT user_id, event_type, mean, top FROM a JOIN b USING (user_id, event_type)""")
def two_key_join(spark, folder):
    events = table(spark, folder, "events")
    a = events.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("mean"))
    b = events.filter("value > 20").groupBy("user_id", "event_type").agg(F.max("value").alias("top"))
    return inner_on(a, b, ["user_id", "event_type"], complete=True)


@query(f"WITH {_TRACKING}, {_STAGED} SELECT DISTINCT s.* FROM staged s LEFT JOIN tracking t ON s.file_location = t.file_location WHERE t.file_location IS NULL")
def new_files(spark, folder):
    return new_only(_staged(spark, folder), _tracking(spark, folder), "file_location")


@query(f"""WITH {_TRACKING} SELECT t.load_id, t.file_location FROM tracking t LEFT JOIN (SELECT load_id FROM status WHERE action_type = 'loaded') s
    ON t.load_id = s.load_id WHERE s.load_id IS NULL AND trim(file_location) <> '' AND file_location IS NOT NULL""")
def pending_files(spark, folder):
    return pending(_tracking(spark, folder), _status(spark, folder), "load_id", path="file_location").select("load_id", "file_location")


@query(f"""WITH {_TRACKING}, {_STAGED}, s AS (SELECT load_id FROM status WHERE action_type = 'loaded')
    SELECT count(*) AS pending FROM (SELECT DISTINCT * FROM staged) n LEFT JOIN tracking t ON n.file_location = t.file_location
    LEFT JOIN s ON t.load_id = s.load_id WHERE s.load_id IS NULL""")
def pending_staged_files(spark, folder):
    return pending_staged(_staged(spark, folder), _tracking(spark, folder).select("load_id", "file_location"), _status(spark, folder))


@query("SELECT doc_id, lang FROM documents WHERE ('0x' || substr(md5('9:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE >= 0.8")
def validation_documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return holdout(docs, sample_fraction(docs, 0.8, "doc_id", 9), "doc_id")


@query("SELECT c_custkey, c_nationkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def nation_of_customers(spark, folder):
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup(table(spark, folder, "customer").select("c_custkey", "c_nationkey"), nation, "c_nationkey")


@query("SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_name) - 1 AS position FROM nation")
def nation_positions(spark, folder):
    return dense_position(table(spark, folder, "nation").select("n_nationkey", "n_name"), "n_name")


@query("""SELECT a.event_id, a.value, b.event_type FROM events a JOIN events b ON a.event_id = b.event_id""")
def glued_columns(spark, folder):
    events = table(spark, folder, "events")
    return glue(events.select("event_id", "value"), events.select("event_id", "event_type"), "event_id")


@query("""SELECT o_orderkey, CAST(d AS BIGINT) AS d, sigma, round(exp(-o_totalprice / 100000 / (sigma * sigma)), 9) AS k FROM orders,
    (VALUES (1), (2)) a(d), (VALUES (1.0::DOUBLE), (1.5), (2.0)) b(sigma)""")
def parameter_cross(spark, folder):
    grid = for_each_param(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), {"d": [1, 2], "sigma": [1.0, 1.5, 2.0]})
    kernel = F.round(F.exp(-F.col("o_totalprice") / 100000 / (F.col("sigma") * F.col("sigma"))), 9)
    return grid.select("o_orderkey", F.col("d").cast("long").alias("d"), "sigma", kernel.alias("k"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 200000")
def stacked_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return stack(orders.filter("o_orderstatus = 'F'"), orders.filter("o_totalprice > 200000")).drop("o_totalprice")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def first_of_each(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return one_per(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def customers_never_seen(spark, folder):
    """Customers without an order."""
    return unseen(table(spark, folder, "customer").selectExpr("c_custkey as k"), table(spark, folder, "orders").selectExpr("o_custkey as k"))


@query("SELECT DISTINCT o_custkey FROM orders")
def distinct_customers(spark, folder):
    return distinct_keys(table(spark, folder, "orders"), "o_custkey")


@query(with_("policy", "SELECT l_orderkey, l_linenumber, ps_car_01_cat, ps_car_04_cat, ps_car_08_cat FROM policy"))
def columns_by_name(spark, folder):
    df = policy(spark, folder)
    return df.select("l_orderkey", "l_linenumber", *cols_like(df, "_car_", "cat"))


@query(with_("policy", "SELECT * EXCLUDE (target, l_partkey, l_suppkey, ps_calc_01, ps_calc_02) FROM policy"))
def predictor_columns(spark, folder):
    df = policy(spark, folder)
    return drop_cols(df.select(*predictors(df, ["target", "l_partkey", "l_suppkey"])), ["ps_calc_01", "ps_calc_02"])


@query(with_("policy", """SELECT name, CASE WHEN name LIKE '%cat' THEN 'categorical' WHEN name LIKE '%bin' THEN 'binary' ELSE 'numeric' END AS role, n
    FROM (SELECT unnest(['ps_ind_03', 'ps_ind_15', 'ps_ind_06_bin', 'ps_reg_01', 'ps_reg_02', 'ps_reg_03', 'ps_car_13', 'ps_car_01_cat', 'ps_car_04_cat',
      'ps_car_08_cat', 'ps_calc_01', 'ps_calc_02', 'ps_calc_03', 'ps_calc_15_bin', 'ps_calc_16_bin', 'ps_calc_17_bin']) AS name), (SELECT count(*) AS n FROM policy)"""))
def roles_of_columns(spark, folder):
    df = policy(spark, folder)
    roles = column_roles(df.drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "target"))
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(r).alias("role")) for r, cols in roles.items() for c in cols])
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.explode(named).alias("c"), "n").select("c.name", "c.role", "n")


@query(with_("policy", """SELECT l_orderkey, l_linenumber, l_partkey, round(ps_reg_01 * ps_reg_03 * ps_reg_02, 9) AS mult,
    round(ps_car_13 * ps_reg_03 * ps_car_13, 8) AS ps_car, ps_ind_03 * ps_ind_15 AS ps_ind FROM policy"""))
def interaction_products(spark, folder):
    out = add_products(policy(spark, folder), {
        "mult": ["ps_reg_01", "ps_reg_03", "ps_reg_02"], "ps_car": ["ps_car_13", "ps_reg_03", "ps_car_13"], "ps_ind": ["ps_ind_03", "ps_ind_15"],
    })
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("mult", 9).alias("mult"), F.round("ps_car", 8).alias("ps_car"), "ps_ind")


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL AND d.lang IS NOT NULL")
def complete_rows(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return drop_incomplete(docs.join(table(spark, folder, "labels"), "doc_id", "left"))


@query("SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority, TRY_CAST(o_orderstatus AS DOUBLE) AS status FROM orders")
def text_to_numbers(spark, folder):
    return to_numeric(table(spark, folder, "orders").select(
        "o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("priority"), F.col("o_orderstatus").alias("status")
    ), ["priority", "status"])


@query("""SELECT img_id, round(bright, 9) AS bright, round(dark, 9) AS dark FROM (SELECT l_orderkey AS img_id, avg(CAST(l_quantity * 5 > 200 AS DOUBLE)) AS bright,
    avg(CAST(l_quantity * 5 < 50 AS DOUBLE)) AS dark FROM lineitem GROUP BY l_orderkey) WHERE bright <= 0.8 AND dark <= 0.4""")
def well_lit_images(spark, folder):
    px = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("img_id"), (F.col("l_quantity") * 5).alias("value"))
    return rounded(good_images(px), 9)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 8 - 200 AS lon, l_discount * 1000 AS lat FROM lineitem
    WHERE abs(l_quantity * 8 - 200) <= 180 AND abs(l_discount * 1000) <= 90""")
def coordinates_in_range(spark, folder):
    df = table(spark, folder, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_quantity * 8 - 200 as lon", "l_discount * 1000 as lat")
    return valid_coords(df, "lon", "lat")[0]


@query("SELECT event_id, least(greatest(value, 10.0), 60.0) AS value, round(least(greatest(exp(value / 100) - 1.0, 0.0), 1.0), 9) AS p FROM events")
def clipped_values(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value", (F.col("value") / 100).alias("p"))
    return clip(expm1_clip(events, "p"), "value", 10.0, 60.0).withColumn("p", F.round("p", 9))


@query(f"WITH {_TRACKING} SELECT load_id, file_location FROM tracking WHERE trim(file_location) <> '' AND file_location IS NOT NULL AND destination_table = '1-URGENT'")
def non_blank_paths(spark, folder):
    return only_table(non_blank(_tracking(spark, folder), "file_location"), "1-URGENT").select("load_id", "file_location")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_3', 'NATION_7', 'NATION_24')")
def whitelisted_nations(spark, folder):
    return whitelist(table(spark, folder, "nation").select("n_nationkey", "n_name"), "n_name", ["NATION_1", "NATION_3", "NATION_7", "NATION_24"])


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS class_index FROM embeddings")
def class_by_argmax(spark, folder):
    return argmax_index(vectors(spark, folder), "vec").select("vec_id", F.col("class_index").cast("long").alias("class_index"))


@query("""SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS class_index FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) WHERE v > 0""")
def positive_labels(spark, folder):
    return label_positions(vectors(spark, folder), "vec")


@query(with_("image_files", """, px AS (SELECT l_orderkey AS img_id, avg(CAST(l_quantity * 5 > 200 AS DOUBLE)) AS bright, avg(CAST(l_quantity * 5 < 50 AS DOUBLE)) AS dark
      FROM lineitem GROUP BY l_orderkey),
    facts AS (SELECT img_path, CAST(split_part(img_path, '/', 5) AS DOUBLE) AS pad_number,
      strftime(strptime(split_part(img_path, '/', 3), '%Y%m%d'), '%Y-%m-%d') AS week_of
      FROM image_files JOIN px USING (img_id) WHERE bright <= 0.8 AND dark <= 0.4),
    pads AS (SELECT o_custkey AS pad_number, strftime(o_orderdate, '%Y-%m-%d') AS week_of, CAST(max(o_totalprice > 250000) AS INTEGER) AS activity FROM orders GROUP BY ALL)
    SELECT f.pad_number, f.week_of, img_path, activity FROM facts f JOIN pads p ON f.pad_number = p.pad_number AND f.week_of = p.week_of"""))
def labelled_image_files(spark, folder):
    files = image_files(spark, folder)
    px = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("img_id"), (F.col("l_quantity") * 5).alias("value"))
    pixels = px.join(files, "img_id").select("img_path", "value")
    pads = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("pad_number"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("week_of")
    ).agg(F.max((F.col("o_totalprice") > 250000).cast("int")).alias("activity"))
    return labelled_images(files.select("img_path"), pixels, pads)


@query(with_("clicks", "SELECT ip, app, click_time FROM clicks"))
def typed_csv_scan(spark, folder):
    path = scratch_path(spark, "clicks")
    df = clicks(spark, folder).select("ip", "app", "device", "os", "channel", F.col("click_time").cast("timestamp").alias("click_time"), "is_attributed")
    write_csv(df, path, 5)
    return scan_csv(spark, path, CLICK_SCHEMA, ["ip", "app", "click_time"]).withColumn("click_time", F.col("click_time").cast("timestamp_ntz"))


@query("SELECT o_orderkey, printf('%.5f', o_totalprice / 7) AS price FROM orders")
def fixed_decimal_csv(spark, folder):
    path = scratch_path(spark, "prices")
    write_csv(table(spark, folder, "orders").select("o_orderkey", (F.col("o_totalprice") / 7).alias("price")), path, 5)
    return spark.read.csv(path, schema="o_orderkey bigint, price string", header=True)


@query("SELECT CAST(o_orderkey AS INTEGER) AS id, round(o_totalprice / 500000, 9) AS target FROM orders")
def submission_table(spark, folder):
    scored = table(spark, folder, "orders").select("o_orderkey", F.round(F.col("o_totalprice") / 500000, 9).alias("p"))
    return submission(scored, "o_orderkey", "p")


@query("SELECT quality, toxic FROM labels")
def label_subset(spark, folder):
    return label_columns(table(spark, folder, "labels"), ["quality", "toxic"])


@query("SELECT vec_id, label, embedding[1] AS first, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 6) AS total FROM embeddings")
def stored_features(spark, folder):
    path = scratch_path(spark, "features")
    write_features(vectors(spark, folder), path, "vec")
    return read_features(spark, path).select(
        "vec_id", "label", F.col("vec")[0].alias("first"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double")), 6).alias("total"),
    )


@query("SELECT event_id, CAST(('0x' || substr(md5('2:' || user_id), 1, 8))::BIGINT % 64 AS BIGINT) AS bucket FROM events")
def hash_buckets(spark, folder):
    return assign_bucket(table(spark, folder, "events").select("event_id", "user_id"), 64, 2, "user_id").select("event_id", "bucket")


@query(f"WITH {_TRACKING} SELECT load_id, (trim(file_location) <> '' AND file_location IS NOT NULL) AS ok FROM tracking")
def blank_path_flags(spark, folder):
    return _tracking(spark, folder).select("load_id", non_blank_text("file_location").alias("ok"))
