"""Tables by catalog name, path or JDBC, and logs appended to them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, name: str, jdbc: dict | None = None) -> DataFrame:
    """A catalog table, a Parquet folder (a name with ``/``), or a database table.

    ``jdbc`` takes the reader's options; give ``partitionColumn``, bounds and
    ``numPartitions`` so that a large table is read by many tasks.
    """
    if jdbc is not None:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.read.parquet(name) if _is_path(name) else spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    if not _is_path(name):
        return spark.catalog.tableExists(name)
    try:
        spark.read.parquet(name).schema
        return True
    except AnalysisException:
        return False


def ensure_table(spark: SparkSession, dest: str, sample: DataFrame) -> bool:
    """Create an empty destination with the columns of ``sample``; true when it was missing."""
    if table_exists(spark, dest):
        return False
    empty = sample.limit(0)
    if _is_path(dest):
        empty.write.parquet(dest)
    else:
        empty.write.saveAsTable(dest)
    return True


def append_log(df: DataFrame, table: str, by: str | None = None) -> None:
    """Append rows to a status or job log, in a partition for each value of the column ``by`` if one is given."""
    writer = df.write.mode("append")
    if by is not None:
        writer = writer.partitionBy(by)
    if _is_path(table):
        writer.parquet(table)
    else:
        writer.format("parquet").saveAsTable(table)


def drop_days(spark: SparkSession, name: str, by: str, before: str) -> list[str]:
    """Delete the partitions whose day (``yyyy-mm-dd``) lies before the given one, files and all; the days that went."""
    if not _is_path(name):
        days = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]  # one row a day
        gone = sorted(d for d in days if d < before)
        for day in gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({by} = '{day}') PURGE")
        return gone
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(name)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in system.listStatus(folder):  # one folder a day
        label = status.getPath().getName()
        if label.startswith(f"{by}=") and label.split("=", 1)[1] < before:
            system.delete(status.getPath(), True)
            gone.append(label.split("=", 1)[1])
    spark.catalog.refreshByPath(name)
    return sorted(gone)
