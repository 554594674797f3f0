"""Due jobs, retention and load reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.order import latest


def due_jobs(log: DataFrame, now, done: str = "done") -> DataFrame:
    """Jobs to run: the last action is missing or not ``done``, or its interval has passed.

    ``load_interval`` is a day-time interval; a job without one is due only
    while it is not done.
    """
    last = latest(log, "job_name", "action_date", nulls_last=False)
    not_done = F.col("action").isNull() | (F.col("action") != done)
    passed = F.coalesce(F.col("action_date") + F.col("load_interval") <= F.lit(now), F.lit(False))
    return last.filter(not_done | passed)


def retain(df: DataFrame, ts: str, days: int, now) -> DataFrame:
    """Rows not older than ``days``."""
    return df.filter(F.col(ts) >= F.lit(now) - F.expr(f"make_dt_interval({int(days)})"))


def load_report(df: DataFrame, by=("file_location",), corrupt: str = "_corrupt_record") -> DataFrame:
    """Rows and failed rows of each file or table."""
    failed = F.count_if(F.col(corrupt).isNotNull()) if corrupt in df.columns else F.lit(0).cast("long")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), failed.alias("failed"))
