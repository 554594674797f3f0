"""Due jobs, retention, and file loads of data written by Spark."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.loads import due_jobs, load_report, retain
from tidewright.operators.order import latest
from tidewright.plans.load_job import LoadJob, load_files, register_files, run_due_jobs, run_job
from tidewright.plans.record_feed import record_batches
from tidewright.queries.fixtures import annotations, table
from tidewright.queries.registry import query
from tidewright.session import scratch_path
from tidewright.sources.records import example_records, read_annotations, read_split, write_shards
from tidewright.sources.tables import append_log, ensure_table, read_table
from tidewright.sources.text_files import discover, mark_done
from tidewright.streaming.loads import load_stream

NOW = datetime(2000, 1, 1)
ORDER_COLUMNS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()),
])


@query("""WITH log AS (SELECT o_custkey AS job_name, o_orderdate AS action_date, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'started' END AS action,
      CASE WHEN o_custkey % 4 > 0 THEN to_days(CAST(o_custkey % 4 * 100 AS INTEGER)) END AS load_interval FROM orders),
    last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY action_date DESC, o_orderkey DESC) = 1)
    SELECT job_name, action_date, action FROM last WHERE (action <> 'done' OR action IS NULL OR action_date + load_interval <= TIMESTAMP '2000-01-01')
      OR (action <> 'done' OR (action IS NULL AND load_interval IS NULL))""")
def jobs_due(spark, folder):
    log = table(spark, folder, "orders").selectExpr(
        "o_custkey as job_name", "o_orderdate as action_date", "o_orderkey",
        "case o_orderstatus when 'F' then 'done' when 'O' then 'started' end as action",
        "case when o_custkey % 4 > 0 then make_dt_interval(cast(o_custkey % 4 * 100 as int)) end as load_interval",
    )
    return due_jobs(log, NOW).select("job_name", "action_date", "action")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 7 DAY")
def retained_rows(spark, folder):
    return retain(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 7, NOW)


def _files(spark, folder):
    """Orders as CSV files, some for each priority."""
    path = scratch_path(spark, "incoming")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    orders.repartition("o_orderpriority", F.pmod(F.xxhash64("o_orderkey"), F.lit(4))).write.partitionBy("o_orderpriority").csv(path, header=True)
    return path


def _job(spark, source, **more):
    base = scratch_path(spark, "load")
    return LoadJob(source, "orders_copy", f"{base}/data", f"{base}/tracking", f"{base}/status", f"{base}/staged", ORDER_COLUMNS, f"{base}/checkpoint", **more)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def loaded_orders(spark, folder):
    """Files found, tracked and loaded eight at a time, newest first; a second run finds nothing."""
    job = _job(spark, _files(spark, folder), files_per_commit=8)
    run_job(spark, job)
    run_job(spark, job)
    return spark.read.parquet(job.data).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def streamed_orders(spark, folder):
    job = _job(spark, _files(spark, folder), files_per_commit=8)
    register_files(spark, job)
    load_stream(spark, job)
    return spark.read.parquet(job.data).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'too few fields' ELSE 'unreadable value' END AS reason, count(*) AS rows FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1""")
def rejected_rows(spark, folder):
    """Every fifth order is written with a broken line; the load keeps it, and the table of rejects says why."""
    path = scratch_path(spark, "incoming")
    key, rest = F.col("o_orderkey").cast("string"), F.concat_ws(",", "o_custkey", "o_totalprice")
    line = F.when(F.col("o_orderkey") % 5 > 0, F.concat_ws(",", key, rest)).when(F.col("o_orderkey") % 3 == 0, key).otherwise(F.concat_ws(",", F.concat(F.lit("x"), key), rest))
    table(spark, folder, "orders").select(line.alias("value"), (F.col("o_orderkey") % 4).alias("part")).write.partitionBy("part").option("compression", "none").text(f"{path}/raw")
    job = _job(spark, path, files_per_commit=8, patterns=("*.txt",), rejects=scratch_path(spark, "rejects"))
    files = discover(spark, path, "*.txt").withColumn("load_id", F.xxhash64("path"))
    load_files(spark, files, job.columns, job.data, job.rejects, header=False).count()
    return read_table(spark, job.rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT o_orderpriority AS job_name, CAST(count(*) AS BIGINT) AS rows, 'done' AS action FROM orders GROUP BY 1
    HAVING arg_max(o_orderstatus, o_orderkey) <> 'F'""")
def due_jobs_done(spark, folder):
    """One job per priority; those whose last log entry is not done are run, loaded and logged, and then none is due."""
    source, log = _files(spark, folder), scratch_path(spark, "jobs")
    entries = table(spark, folder, "orders").selectExpr(
        "o_orderpriority as job_name", "timestamp_seconds(o_orderkey) as action_date", "if(o_orderstatus = 'F', 'done', 'started') as action",
        "cast(null as interval day to second) as load_interval",
    )
    append_log(entries, log)
    names = sorted(r[0] for r in entries.select("job_name").distinct().collect())
    jobs = {name: _job(spark, f"{source}/o_orderpriority={name}", files_per_commit=8) for name in names}
    ran = run_due_jobs(spark, log, jobs, NOW)
    left = run_due_jobs(spark, log, jobs, NOW)
    loaded = spark.createDataFrame([], "job_name string, o_orderkey bigint")
    for name in [n for n in ran if n not in left]:
        loaded = loaded.unionByName(spark.read.parquet(jobs[name].data).select(F.lit(name).alias("job_name"), "o_orderkey"))
    last = latest(read_table(spark, log), "job_name", "action_date").select("job_name", "action")
    return loaded.groupBy("job_name").agg(F.count(F.lit(1)).alias("rows")).join(last, "job_name")


@query("SELECT o_orderpriority AS priority, count(*) AS rows, CAST(0 AS BIGINT) AS failed FROM orders GROUP BY 1")
def rows_per_folder(spark, folder):
    path = _files(spark, folder)
    found = discover(spark, path, "*.csv").select(F.url_decode(F.regexp_extract("path", "o_orderpriority=([^/]+)/", 1)).alias("priority")).distinct()
    rows = spark.read.csv(path, schema=T.StructType([*ORDER_COLUMNS.fields, T.StructField("o_orderpriority", T.StringType())]), header=True)
    return load_report(rows.withColumnRenamed("o_orderpriority", "priority").join(found, "priority"), ["priority"])


@query("SELECT r_name, '1' AS content FROM region")
def run_markers(spark, folder):
    """A marker file per region, found again by the parameter in its name."""
    path = scratch_path(spark, "markers")
    for row in table(spark, folder, "region").select("r_name").collect():
        mark_done(spark, path, region=row["r_name"])
    name = F.url_decode(F.regexp_extract(F.input_file_name(), "region-(.*)_[0-9]+/[^/]*$", 1))
    return spark.read.option("recursiveFileLookup", "true").text(path).select(name.alias("r_name"), F.col("value").alias("content"))


@query("SELECT o_orderkey AS load_id, CASE WHEN o_orderstatus = 'F' THEN 'loaded' ELSE 'failed' END AS action_type FROM orders")
def status_log(spark, folder):
    """A log created empty and appended to in two parts."""
    path = scratch_path(spark, "log")
    rows = table(spark, folder, "orders").selectExpr("o_orderkey as load_id", "case when o_orderstatus = 'F' then 'loaded' else 'failed' end as action_type")
    ensure_table(spark, path, rows)
    append_log(rows.filter("action_type = 'loaded'"), path)
    append_log(rows.filter("action_type = 'failed'"), path)
    return read_table(spark, path)


@query("""SELECT l_orderkey AS img_id, l_linenumber * 100000000000000 + l_partkey * 100000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS truth_id, CAST(l_partkey % 40 * 4 AS DOUBLE) AS x, 40 + l_quantity AS w FROM lineitem""")
def annotation_documents(spark, folder):
    """Annotations written as JSON documents and read back."""
    path = scratch_path(spark, "annotations")
    docs = annotations(spark, folder).select(
        F.array(F.struct(F.col("img_id").alias("id"))).alias("images"),
        F.array(F.struct(
            F.col("truth_id").alias("id"), F.col("img_id").alias("image_id"), F.lit(1).alias("category_id"),
            F.array("bbox.x", "bbox.y", "bbox.w", "bbox.h").alias("bbox"),
        )).alias("annotations"),
        F.array(F.struct(F.lit(1).alias("id"), F.lit("thing").alias("name"))).alias("categories"),
    )
    docs.select("images", "annotations", "categories").write.json(path)
    found = read_annotations(spark, path, multi_line=False)[1]
    return found.select("img_id", "truth_id", F.col("bbox.x").alias("x"), F.col("bbox.w").alias("w"))


def _records(spark, folder):
    """Orders as example records; those with status P have no boxes."""
    side = "case when o_orderstatus <> 'P' then transform(sequence(0, cast(o_custkey % 4 as int)), i -> cast(i * {0} as float)) end as {1}"
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as id", "encode(o_orderpriority, 'utf-8') as encoded",
        "case when o_orderstatus = 'F' then 'png' end as format", "case when o_orderstatus <> 'P' then o_custkey end as label",
        "cast(null as string) as text", side.format(3, "ymin"), side.format(4, "xmin"), side.format(5, "ymax"), side.format(6, "xmax"),
        "cast(null as array<bigint>) as object_label", "if(o_orderstatus = 'O', 'validation', 'train') as split",
    )


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'png' ELSE 'jpeg' END AS format,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN o_custkey ELSE -1 END AS INTEGER) AS label, '' AS text, CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 4 + 1 ELSE 0 END AS n_boxes FROM orders""")
def records_with_defaults(spark, folder):
    out = example_records(_records(spark, folder))
    return out.select("id", "format", "label", "text", F.size("boxes").cast("long").alias("n_boxes"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O'")
def validation_shards(spark, folder):
    path = scratch_path(spark, "shards")
    records = _records(spark, folder).select("id", "split")
    write_shards(records.filter("split = 'train'"), path, 8, "train", "id")
    write_shards(records.filter("split = 'validation'"), path, 4, "validation", "id")
    return read_split(spark, path, "validation").select("id")


@query("""SELECT o_orderkey AS id, batch FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY md5('0-1:' || o_orderkey), o_orderkey) - 1) // 64 AS batch, count(*) OVER () AS n
    FROM orders WHERE o_orderstatus <> 'O') WHERE batch < n // 64""")
def training_batches(spark, folder):
    path = scratch_path(spark, "shards")
    write_shards(_records(spark, folder).filter("split = 'train'"), path, 8, "train", "id")
    return record_batches(spark, path, "train", 64, "id", seed=0, epoch=1).select("id", "batch")
