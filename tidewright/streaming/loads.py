"""File loads as a stream: newest first, n files per commit, each commit once."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.plans.load_job import STATUS_SCHEMA, TRACKING_SCHEMA, LoadJob, _read_or_empty, register_paths
from tidewright.sources.tables import append_log
from tidewright.sources.text_files import plain_path


def commit_batch(df: DataFrame, batch_id: int, job: LoadJob) -> None:
    """Write one micro-batch and its status rows.

    Files that no scan has registered are registered first, so none is lost. A batch whose status rows exist is skipped. Data goes to one folder per
    load, replaced as a whole, so a batch that failed between data and status
    writes the same rows again.
    """
    spark = df.sparkSession
    status = _read_or_empty(spark, job.status, STATUS_SCHEMA)
    if not status.filter(F.col("batch_id") == batch_id).isEmpty():
        return
    register_paths(spark, job, df.select("path"))
    tracking = _read_or_empty(spark, job.tracking, TRACKING_SCHEMA)
    done = status.filter("action_type = 'loaded'").select("load_id")
    todo = tracking.join(done, "load_id", "left_anti").select("load_id", "path", "destination_schema")
    keyed = df.join(todo, "path")
    (keyed.drop("path", "destination_schema").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(job.data))
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    files = keyed.select("load_id", "destination_schema").distinct()
    append_log(
        files.select("load_id", F.col("destination_schema").alias("schema_title"), F.lit("loaded").alias("action_type"),
                     F.lit(now).alias("action_date"), F.lit(batch_id).cast("long").alias("batch_id")),
        job.status,
    )


def load_stream(spark: SparkSession, job: LoadJob, files_per_commit: int | None = None):
    """Load everything available and stop; the checkpoint remembers finished files."""
    schema = T.StructType([*job.columns.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = (
        spark.readStream.schema(schema)
        .option("header", "true")
        .option("latestFirst", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_commit or job.files_per_commit)
        .csv(job.scan_location)
        .withColumn("path", plain_path(F.col("_metadata.file_path")))
    )
    query = (
        rows.writeStream.foreachBatch(lambda df, batch_id: commit_batch(df, batch_id, job))
        .option("checkpointLocation", job.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
