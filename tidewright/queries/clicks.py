"""Click features, counts, neighbours in time."""

from pyspark.sql import functions as F

from tidewright.operators.counts import CLICK_COUNT_KEYS, add_counts, click_counts, distinct_rows, histogram, row_count, split_sizes
from tidewright.operators.order import latest
from tidewright.operators.select import series_range
from tidewright.operators.sequence import first_arrival, next_gap, previous
from tidewright.plans.click_features import click_features
from tidewright.queries.fixtures import clicks, rounded, series, table, with_
from tidewright.queries.registry import query

_COUNTS = ",\n".join(
    f"count(*) OVER (PARTITION BY {', '.join(k)}) AS {'_'.join(k)}_count" for k in CLICK_COUNT_KEYS
)
_TIMED = """timed AS (SELECT *, CAST(day(click_time) AS SMALLINT) AS day, CAST(hour(click_time) AS SMALLINT) AS hour,
    CAST(minute(click_time) AS SMALLINT) AS minute, CAST(floor(epoch(click_time)) AS BIGINT) AS t FROM clicks)"""
_EPOCH = "epoch_us(click_time) // 1000000"


@query(with_("clicks", f""", {_TIMED.replace('CAST(floor(epoch(click_time)) AS BIGINT)', _EPOCH)}
    SELECT click_id, ip, app, device, os, channel, click_time, is_attributed, day, hour, minute, {_COUNTS},
      t AS epochtime,
      coalesce(lead(t) OVER (PARTITION BY ip, app, device, os ORDER BY click_time, click_id), 3000000000) - t AS next_click,
      CAST(('0x' || substr(md5('0:' || ip || '_' || app || '_' || device || '_' || os), 1, 8))::BIGINT % 67108864 AS BIGINT) AS category
    FROM timed"""))
def click_feature_table(spark, folder):
    return click_features(clicks(spark, folder))


@query(with_("clicks", f""", {_TIMED.replace('CAST(floor(epoch(click_time)) AS BIGINT)', _EPOCH)}
    SELECT click_id, day, hour, minute, {_COUNTS} FROM timed"""))
def nine_click_counts(spark, folder):
    counted = click_counts(clicks(spark, folder))
    return counted.select("click_id", "day", "hour", "minute", *["_".join(k) + "_count" for k in CLICK_COUNT_KEYS])


@query("SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id, event_type) AS user_id_event_type_count FROM events")
def group_counts(spark, folder):
    return add_counts(table(spark, folder, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"])


@query("""SELECT event_id, coalesce(lead(epoch_us(ts) // 1000000) OVER (PARTITION BY user_id ORDER BY ts, event_id), 3000000000)
    - epoch_us(ts) // 1000000 AS next_gap FROM events""")
def next_event_gap(spark, folder):
    return next_gap(table(spark, folder, "events"), "user_id", "ts", "event_id").select("event_id", "next_gap")


@query("""SELECT event_id, coalesce(lead(epoch_us(ts) // 1000000) OVER (PARTITION BY event_type ORDER BY ts, event_id), 3000000000)
    - epoch_us(ts) // 1000000 AS next_gap FROM events""")
def next_event_gap_hot_keys(spark, folder):
    """The same on five keys only, each cut into time slices."""
    events = table(spark, folder, "events")
    return next_gap(events, "event_type", "ts", "event_id", hot_rows=100, slices=16).select("event_id", "next_gap")


@query("SELECT event_id, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS previous FROM events")
def previous_value(spark, folder):
    events = table(spark, folder, "events")
    return previous(events, "user_id", ["ts", "event_id"], "value", 0.0).select("event_id", "previous")


@query(with_("series", """, coded AS (SELECT *, cloud * 10 + water AS code FROM series),
    stepped AS (SELECT *, lag(code, 1, 0) OVER (PARTITION BY series_id ORDER BY ts) AS before FROM coded),
    facts AS (SELECT series_id, min(ts) FILTER (WHERE code < 10 AND code - before = 1) AS arrived,
        arg_min(code, ts) FILTER (WHERE code < 10) AS first, count(*) FILTER (WHERE code < 10) AS clear_n
      FROM stepped GROUP BY series_id)
    SELECT series_id, CAST(CASE WHEN clear_n = 0 THEN NULL WHEN first = 1 OR clear_n = 1 THEN -1 ELSE 0 END AS INTEGER) AS status,
      CASE WHEN clear_n > 1 AND first <> 1 THEN arrived END AS found_at, clear_n FROM facts"""))
def arrival_by_series(spark, folder):
    return first_arrival(series(spark, folder), "series_id", "ts", "cloud", "water")


@query(with_("series", """, inside AS (SELECT * FROM series WHERE ts BETWEEN TIMESTAMP '2017-01-01' AND TIMESTAMP '2024-01-20'),
    days AS (SELECT *, CAST(ts AS DATE) AS day FROM inside)
    SELECT series_id, day, event_id, value FROM days
    WHERE (series_id, day) IN (SELECT (series_id, day) FROM days GROUP BY series_id, day HAVING avg(cloud) <= 0.25)"""))
def clear_days_of_series(spark, folder):
    days = series(spark, folder).filter(F.col("ts").between(F.lit("2017-01-01").cast("timestamp"), F.lit("2024-01-20").cast("timestamp")))
    days = days.withColumn("day", F.to_date("ts"))
    return series_range(days, "day", "2017-01-01", "2024-01-20", 0.25).select("series_id", "day", "event_id", "value")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_order(spark, folder):
    return latest(table(spark, folder, "orders"), "o_custkey", "o_orderdate")


@query("SELECT count(*) AS n FROM lineitem")
def count_rows(spark, folder):
    return row_count(table(spark, folder, "lineitem"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark, folder):
    return distinct_rows(table(spark, folder, "events").select("user_id", "event_type"))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def sizes_by_language(spark, folder):
    return split_sizes(table(spark, folder, "documents"), "lang")


@query("""SELECT CAST(least(floor(l_quantity * 5 / 1.0), 255) AS INTEGER) AS bin, count(*) AS n FROM lineitem
    WHERE l_quantity * 5 BETWEEN 0 AND 256 GROUP BY 1""")
def value_histogram(spark, folder):
    return histogram(table(spark, folder, "lineitem").select((F.col("l_quantity") * 5).alias("v")), "v", 0, 256)


@query("""WITH runs AS (SELECT event_id AS run, epoch_us(ts) / 1e6 AS before,
      epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS after FROM events),
    full_runs AS (SELECT * FROM runs WHERE after IS NOT NULL)
    SELECT count(*) AS runs, round(1000000.0::DOUBLE * (count(*) - 1) / count(*) /
      (sum(after - before) - arg_min(after - before, run)), 6) AS samples_per_sec FROM full_runs""")
def timed_throughput(spark, folder):
    from pyspark.sql import Window

    from tidewright.operators.metrics import throughput

    events = table(spark, folder, "events").withColumn("before", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    nxt = F.lead("before").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    runs = events.select(F.col("event_id").alias("run"), "before", nxt.alias("after")).filter("after is not null")
    return rounded(throughput(runs, 1000000))
