"""Streams over the event table, run until everything available is read."""

from pyspark.sql import functions as F

from tidewright.queries.fixtures import EVENT_TYPES, table
from tidewright.queries.registry import query
from tidewright.session import scratch_path
from tidewright.sources.tables import read_table
from tidewright.streaming.closing import run_to_end
from tidewright.streaming.evaluate import accuracy_of_hits, stream_eval
from tidewright.streaming.events import stream_counts, stream_distinct, stream_first_arrival, stream_next_gap

def _stream(spark, folder, name="events"):
    """One table of the folder as a file stream; times as instants."""
    schema = table(spark, folder, name).schema
    path = f"{folder}/{name}.parquet"
    # A table of size is a folder of part files; a single file is picked by name in its folder.
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
    reader = spark.readStream.schema(schema)
    rows = reader.parquet(path) if is_folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in rows.columns else rows


def _naive(df):
    """Instants as the plain timestamps of the given tables."""
    return df.select(*[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


def _to_end(spark, sdf, label, make):
    """The whole result of a stream: read until its input is used up, then closed."""
    path = scratch_path(spark, label)
    return _naive(run_to_end(sdf, make, "ts", path, path + "-checkpoint"))


@query("""SELECT user_id, event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n
    FROM events GROUP BY 1, 2, 3, 4""")
def windowed_stream_counts(spark, folder):
    return _to_end(spark, _stream(spark, folder), "counts", lambda s: stream_counts(s, ["user_id", "event_type"], "ts", "1 hour", "10 minutes"))


@query("""SELECT user_id, event_id, coalesce(lead(epoch_us(ts) // 1000000) OVER (PARTITION BY user_id ORDER BY ts, event_id), 3000000000)
    - epoch_us(ts) // 1000000 AS next_gap FROM events""")
def next_gap_on_stream(spark, folder):
    """Every event, the last of each user with its sentinel."""
    return _to_end(spark, _stream(spark, folder), "gaps", lambda s: stream_next_gap(s, "user_id", "ts", "event_id", "10 minutes"))


@query("""WITH coded AS (SELECT user_id AS series_id, ts, CASE WHEN event_type = 'error' THEN 10 ELSE 0 END + CAST(value > 40 AS INTEGER) AS code FROM events),
    stepped AS (SELECT *, lag(code, 1, 0) OVER (PARTITION BY series_id ORDER BY ts) AS before FROM coded),
    facts AS (SELECT series_id, min(ts) FILTER (WHERE code < 10 AND code - before = 1) AS arrived, arg_min(code, ts) FILTER (WHERE code < 10) AS first,
        count(*) FILTER (WHERE code < 10) AS clear_n FROM stepped GROUP BY series_id)
    SELECT series_id, CAST(CASE WHEN clear_n = 0 THEN NULL WHEN first = 1 OR clear_n = 1 THEN -1 ELSE 0 END AS INTEGER) AS status,
        CASE WHEN clear_n > 1 AND first <> 1 THEN arrived END AS found_at FROM facts""")
def first_arrival_on_stream(spark, folder):
    """A status for each series."""
    series = _stream(spark, folder).selectExpr("user_id as series_id", "ts", "cast(event_type = 'error' as int) as cloud", "cast(value > 40 as int) as water")
    return _to_end(spark, series, "arrivals", lambda s: stream_first_arrival(s, "series_id", "ts", "cloud", "water"))


@query("SELECT DISTINCT user_id FROM events")
def deduplicated_stream(spark, folder):
    """One row per user, however far apart the copies lie."""
    return _to_end(spark, _stream(spark, folder).select("user_id", "ts"), "users", lambda s: stream_distinct(s, "user_id", "ts", "1 day")).select("user_id")


@query("""SELECT day(ts) AS step, count(*) AS n, round(avg(CAST(own >= best AS DOUBLE)), 9) AS top_1, round(avg(CAST(better < 3 AS DOUBLE)), 9) AS top_3
    FROM (SELECT ts, CASE event_type WHEN 'click' THEN s0 WHEN 'error' THEN s1 WHEN 'purchase' THEN s2 WHEN 'signup' THEN s3 ELSE s4 END AS own,
        greatest(s0, s1, s2, s3, s4) AS best,
        len(list_filter([s0, s1, s2, s3, s4], lambda s: s > CASE event_type WHEN 'click' THEN s0 WHEN 'error' THEN s1 WHEN 'purchase' THEN s2 WHEN 'signup' THEN s3 ELSE s4 END)) AS better
      FROM (SELECT ts, event_type, event_id * 7 % 101 AS s0, event_id * 11 % 101 AS s1, event_id * 13 % 101 AS s2, event_id * 17 % 101 AS s3, event_id * 19 % 101 AS s4 FROM events))
    GROUP BY 1""")
def evaluated_stream(spark, folder):
    scores = F.array(*[(F.col("event_id") * m % 101).cast("double") for m in (7, 11, 13, 17, 19)])
    scored = _stream(spark, folder).select(
        F.dayofmonth("ts").cast("long").alias("step"), (F.array_position(F.lit(EVENT_TYPES), F.col("event_type")) - 1).cast("int").alias("label"), scores.alias("scores")
    )
    path = scratch_path(spark, "accuracy")
    stream_eval(scored, 3, path, path + "-checkpoint")
    out = accuracy_of_hits(read_table(spark, path), "step", 3)
    return out.select("step", "n", F.round("top_1", 9).alias("top_1"), F.round("top_3", 9).alias("top_3"))
