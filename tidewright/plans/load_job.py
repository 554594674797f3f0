"""Incremental file loads: discover, register, load in batches, report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import strip_home
from tidewright.operators.joins import new_only, pending
from tidewright.operators.loads import due_jobs, load_report, retain
from tidewright.operators.order import newest, row_index
from tidewright.operators.select import only_table
from tidewright.sources.tables import append_log, drop_days, read_table, table_exists
from tidewright.sources.text_files import discover_many, plain_path

RETENTION_DAYS = 7
STAGED_DAY = "staged_day"
TRACKING_SCHEMA = "load_id bigint, path string, file_location string, destination_table string, destination_schema string, date_created timestamp"
STATUS_SCHEMA = "load_id bigint, schema_title string, action_type string, action_date timestamp, batch_id bigint"


@dataclass(frozen=True)
class LoadJob:
    """Where a job scans and writes. Tables are catalog names or Parquet folders.

    ``file_location`` is what is shown of a file, without ``home``; ``path`` is what the reader gets.
    """

    scan_location: str
    destination_table: str
    data: str
    tracking: str
    status: str
    staged: str
    columns: T.StructType
    checkpoint: str
    destination_schema: str | None = None
    files_per_commit: int = 100
    home: str = ""
    patterns: tuple[str, ...] = ("*.csv",)
    #: Rows that could not be read go here with their load and reason, if it is given; they stay in the data, marked, as well.
    rejects: str | None = None

    def __post_init__(self):
        if not self.scan_location:
            raise ValueError("a job needs a folder to scan")
        if not self.destination_table:
            raise ValueError("a job needs a destination table")


def _read_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    return read_table(spark, name) if table_exists(spark, name) else spark.createDataFrame([], schema)


def register_files(spark: SparkSession, job: LoadJob, now: datetime | None = None, keep=None) -> int:
    """Stage the files found, delete the days that are too old, and track the paths not tracked yet; how many were new.

    Staged rows lie in one partition a day, and whole days before ``RETENTION_DAYS`` ago are dropped from the table.
    """
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    found = discover_many(spark, job.scan_location, job.patterns, keep)
    location = strip_home("path", job.home) if job.home else F.col("path")
    staged_now = found.select(
        F.lit(now).alias("date_created"), F.col("path"), location.alias("file_location"),
        F.lit(job.destination_table).alias("destination_table"), F.lit(job.destination_schema).cast("string").alias("destination_schema"),
    )
    kept = staged_now
    if table_exists(spark, job.staged):
        drop_days(spark, job.staged, STAGED_DAY, (now - timedelta(days=RETENTION_DAYS)).strftime("%Y-%m-%d"))
    if table_exists(spark, job.staged):  # unless no day is left
        kept = retain(read_table(spark, job.staged).drop(STAGED_DAY), "date_created", RETENTION_DAYS, now).unionByName(staged_now)
    tracking = _read_or_empty(spark, job.tracking, TRACKING_SCHEMA)
    count = _track(spark, job, kept, tracking, now)
    append_log(staged_now.withColumn(STAGED_DAY, F.lit(now.strftime("%Y-%m-%d"))), job.staged, STAGED_DAY)
    return count


def _track(spark: SparkSession, job: LoadJob, files: DataFrame, tracking: DataFrame, now: datetime) -> int:
    """Give load ids to files (path, file_location, ...) that have none yet; how many these were."""
    fresh = new_only(files.select("path", "file_location", "destination_table", "destination_schema"), tracking, "file_location")
    last = tracking.agg(F.max("load_id")).first()[0] or 0
    numbered = row_index(fresh, ["file_location", "destination_table"], "_n")
    rows = numbered.select(
        (F.col("_n") + 1 + last).alias("load_id"), "path", "file_location", "destination_table", "destination_schema",
        F.lit(now).alias("date_created"),
    )
    count = numbered.count()
    append_log(rows, job.tracking)
    return count


def register_paths(spark: SparkSession, job: LoadJob, paths: DataFrame, now: datetime | None = None) -> int:
    """Track the files of a frame with a ``path`` column, as a stream meets them before any scan does."""
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    location = strip_home("path", job.home) if job.home else F.col("path")
    files = paths.select("path").distinct().select(
        "path", location.alias("file_location"), F.lit(job.destination_table).alias("destination_table"),
        F.lit(job.destination_schema).cast("string").alias("destination_schema"),
    )
    return _track(spark, job, files, _read_or_empty(spark, job.tracking, TRACKING_SCHEMA), now)


def next_batch(spark: SparkSession, job: LoadJob, table: str | None = None) -> DataFrame:
    """The newest files still to load, at most ``files_per_commit``; blank paths and files of another kind are never pending."""
    tracking = only_table(_read_or_empty(spark, job.tracking, TRACKING_SCHEMA), table)
    status = _read_or_empty(spark, job.status, STATUS_SCHEMA)
    unreadable = status.filter("action_type = 'failed'").select("load_id")
    tracking = tracking.join(unreadable, "load_id", "left_anti")
    return newest(pending(tracking, status, "load_id", path="file_location"), "date_created", job.files_per_commit, "load_id")


def load_files(spark: SparkSession, files: DataFrame, schema: T.StructType, dest: str, rejects: str | None = None, header: bool = True) -> DataFrame:
    """Append the rows of a batch of files with their ``load_id``; returns the rows per file.

    With ``rejects``, rows that could not be read are also appended to that table as load_id, record and reason.

    The paths of one batch are at most the job's files per commit, so handing
    them to the reader is bounded. The folder of a load is overwritten as a
    whole, so a batch that is run again does not double its rows.
    """
    batch = files.select("load_id", "path").collect()
    if not batch:
        return spark.createDataFrame([], "load_id bigint, rows bigint, failed bigint")
    read_schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.csv([r["path"] for r in batch], schema=read_schema, header=header).withColumn(
        "_path", plain_path(F.col("_metadata.file_path"))
    )
    keyed = rows.join(F.broadcast(files.select("load_id", F.col("path").alias("_path"))), "_path")  # one batch of paths
    (keyed.drop("_path").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_id").parquet(dest))
    loaded = spark.read.schema(T.StructType([*read_schema.fields, T.StructField("load_id", T.LongType())])).option("basePath", dest).parquet(
        *_folders(spark, dest, [r["load_id"] for r in batch])
    )
    if rejects is not None:
        # Rows of the batch as they lie in the data, so a batch that is run again writes them again under its load id.
        fields = F.size(F.split("_corrupt_record", ","))
        reason = F.when(fields < len(schema), "too few fields").when(fields > len(schema), "too many fields").otherwise("unreadable value")
        bad = loaded.where(F.col("_corrupt_record").isNotNull()).select("load_id", F.col("_corrupt_record").alias("record"), reason.alias("reason"))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(rejects)
    return load_report(loaded, ["load_id"])


def _folders(spark: SparkSession, dest: str, loads: list[int]) -> list[str]:
    """The folders of one batch that hold rows; the rest of the destination is not listed. A file without rows has none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    paths = [f"{dest}/load_id={i}" for i in loads]
    system = hadoop.Path(dest).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [p for p in paths if system.exists(hadoop.Path(p))]
    return found or [dest]


def run_due_jobs(spark: SparkSession, log: str, jobs: dict[str, LoadJob], now: datetime | None = None) -> list[str]:
    """Run each known job that the action log says is due and append its ``done`` row; names in the order they ran.

    The log has job_name, action, action_date and load_interval; a job that fails leaves no ``done`` row, so it is due again.
    """
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    entries = read_table(spark, log)
    due = due_jobs(entries, now).where(F.col("job_name").isin(*jobs)).select(*entries.columns).orderBy("job_name")
    ran = []
    for row in due.collect():  # at most one row per known job
        run_job(spark, jobs[row["job_name"]], now)
        done = spark.createDataFrame([row], entries.schema).withColumns(
            {"action": F.lit("done"), "action_date": F.lit(now).cast(entries.schema["action_date"].dataType)}
        )
        append_log(done, log)
        ran.append(row["job_name"])
    return ran


def run_job(spark: SparkSession, job: LoadJob, now: datetime | None = None) -> DataFrame:
    """Register new files and load batches, newest first, until none is pending.

    Files are read as CSV; a file of another kind that the job's patterns let through gets the status ``failed``.
    """
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    register_files(spark, job, now)
    report, batch_id = None, 0
    while True:
        files = next_batch(spark, job)
        files = spark.createDataFrame(files.collect(), files.schema)  # one batch, at most files_per_commit rows
        if files.isEmpty():
            break
        is_csv = F.lower("path").endswith(".csv")
        done = load_files(spark, files.where(is_csv), job.columns, job.data, job.rejects)
        rows = spark.createDataFrame(done.collect(), done.schema)  # one row per file of the batch
        append_log(
            files.select("load_id", F.col("destination_schema").alias("schema_title"), F.when(is_csv, "loaded").otherwise("failed").alias("action_type"),
                         F.lit(now).alias("action_date"), F.lit(-1 - batch_id).cast("long").alias("batch_id")),  # apart from the numbers of a stream
            job.status,
        )
        report = rows if report is None else report.unionByName(rows)
        batch_id += 1
    return report if report is not None else spark.createDataFrame([], "load_id bigint, rows bigint, failed bigint")
