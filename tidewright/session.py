"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

#: Spark's switch that removes shuffle files at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "tidewright", cores: int | str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect.

    On a cluster the master, shuffle partitions and checkpoint folder come from
    spark-submit; ``cores`` is for local runs only.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per session, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_tidewright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidewright-package-")) / "tidewright-package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))  # the driver's own copy; Spark sends it to the executors
    context._tidewright_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, taken from the session where it is set.

    Only a local session without the setting gets a temporary folder; on a
    cluster the executors could not see one, so a missing setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tidewright-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared checkpoint folder for a table written by a job."""
    return os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut(df):
    """Materialise a frame in the shared folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def tidy_shuffles(spark: SparkSession):
    """Shuffle files of a query are removed as it ends, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df, label: str):
    """Write a frame once below the shared checkpoint folder and read it from there.

    Unlike ``cut`` it computes the frame once; an eager checkpoint does so twice.
    """
    path = scratch_path(df.sparkSession, label)
    with tidy_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Delete the files of a frame from ``stored`` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
