"""The end of a stream: a closing row behind all data moves the watermark past every timer and window."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import scratch_path

#: Data is older than this; timers set to it fire when the stream is closed.
END = datetime(2200, 1, 1, tzinfo=timezone.utc)
END_MS = int(END.timestamp() * 1000)
#: Time of the closing row; the watermark that follows is past ``END`` for delays below fifty years.
CLOSING_ROW = datetime(2250, 1, 1, tzinfo=timezone.utc)
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def watermarked(sdf: DataFrame, ts: str, delay: str) -> DataFrame:
    """The watermark of all rows, and then the rows without the closing one.

    The condition is on the event time, so it stays above the watermark in the plan.
    """
    return sdf.withWatermark(ts, delay).filter(F.col(ts) < F.lit(END))


def _closing_rows(sdf: DataFrame, ts: str, rows: int) -> DataFrame:
    spark = sdf.sparkSession
    one = spark.range(rows).select(*[
        (F.lit(CLOSING_ROW) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in sdf.schema
    ])
    return one.coalesce(1)


def run_to_end(sdf: DataFrame, make: Callable[[DataFrame], DataFrame], ts: str, path: str, checkpoint: str) -> DataFrame:
    """Write ``make(sdf)`` to Parquet until the input is used up, then close the stream and write what was still open.

    The closing row comes by a second file source, which stays empty until a first run has read all input: rows of
    one trigger could not follow it. ``make`` applies ``watermarked``. Both runs share the checkpoint, so a run that was
    stopped goes on where it was.
    """
    spark = sdf.sparkSession
    folder = scratch_path(spark, "closing")
    _closing_rows(sdf, ts, 0).write.parquet(folder)
    out = make(sdf.unionByName(spark.readStream.schema(sdf.schema).parquet(folder)))
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        for closing in (False, True):
            if closing:
                _closing_rows(sdf, ts, 1).write.mode("append").parquet(folder)
            writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            writer.trigger(availableNow=True).start(path).awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.schema(out.schema).parquet(path)
