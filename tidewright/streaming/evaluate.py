"""Evaluate scored output as it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.sources.tables import append_log, read_table, table_exists


def step_accuracy(scored: DataFrame, k: int, step: str = "step", label: str = "label", scores: str = "scores") -> DataFrame:
    """Top-1 and top-k accuracy of each step."""
    return accuracy_of_hits(step_hits(scored, k, step, label, scores), step, k)


def step_hits(scored: DataFrame, k: int, step: str = "step", label: str = "label", scores: str = "scores") -> DataFrame:
    """Rows, top-1 hits and top-k hits of each step; they add up over batches."""
    own = F.element_at(F.col(scores), F.col(label) + 1)
    better = F.size(F.filter(scores, lambda s: s > own))
    return scored.groupBy(step).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(better < 1).alias("hits_1"), F.count_if(better < k).alias("hits_k")
    )


def accuracy_of_hits(hits: DataFrame, step: str, k: int) -> DataFrame:
    """Accuracy of each step from any number of partial counts."""
    n = F.sum("n")
    return hits.groupBy(step).agg(n.alias("n"), (F.sum("hits_1") / n).alias("top_1"), (F.sum("hits_k") / n).alias(f"top_{k}"))


def stream_eval(sdf: DataFrame, k: int, table: str, checkpoint: str, last_step: int | None = None, timeout: int | None = None,
                step: str = "step", available_now: bool = True):
    """Append the hit counts of each step and batch to ``table``; ``accuracy_of_hits`` adds them up.

    Ends when everything available is evaluated, or in a running stream after
    ``last_step`` or after ``timeout`` seconds without it.
    """
    reached = {"last": False}

    def evaluate(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if table_exists(spark, table) and not read_table(spark, table).filter(F.col("batch_id") == batch_id).isEmpty():
            return
        rows = step_hits(batch, k, step).withColumn("batch_id", F.lit(batch_id).cast("long"))
        append_log(rows, table)
        if last_step is not None and not batch.filter(F.col(step) >= last_step).isEmpty():
            reached["last"] = True

    writer = sdf.writeStream.foreachBatch(evaluate).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        query.awaitTermination()
        return query
    waited = 0
    while query.isActive and not reached["last"] and (timeout is None or waited < timeout):
        query.awaitTermination(1)
        waited += 1
    query.stop()
    return query
