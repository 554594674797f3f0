"""Ranking metrics, confusion counts, losses and timing reports.

Scores are first counted per distinct value, so ties are exact and only one row
per distinct score is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on
from tidewright.operators.order import _as_list, prefix_sums


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, type I error (false alarms of negatives) and type II (misses of positives)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y).alias("positives"),
        F.count_if(~y).alias("negatives"),
        F.count_if(F.col(label) == F.col(pred)).alias("correct"),
        F.count_if(y & ~p).alias("false_neg"),
        F.count_if(~y & p).alias("false_pos"),
    )
    return counts.select(
        "n", (F.col("correct") / F.col("n")).alias("accuracy"),
        F.try_divide("false_neg", "positives").alias("type_2"),
        F.try_divide("false_pos", "negatives").alias("type_1"),
    )


def top_k_accuracy(df: DataFrame, label: str, scores: str, k: int) -> DataFrame:
    """Share of rows whose label is among the ``k`` best scores; a tie counts as a hit."""
    own = F.element_at(F.col(scores), F.col(label) + 1)
    better = F.size(F.filter(scores, lambda s: s > own))
    hit = (better < k).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias(f"top_{k}"))


def _score_counts(df: DataFrame, label: str, score: str, by) -> DataFrame:
    return df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, score: str, by=(), name: str = "auc") -> DataFrame:
    """Area under the ROC curve; a tied pair counts half, one class alone gives null."""
    by = list(by)
    cum = prefix_sums(_score_counts(df, label, score, by), [score], {"neg_to": "neg"}, by)
    below = F.col("neg_to") - F.col("neg")
    sums = cum.groupBy(*by).agg(
        F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2)).alias("_wins"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
    )
    return sums.select(*by, F.try_divide("_wins", F.col("_p").cast("double") * F.col("_n")).alias(name))


def gini(df: DataFrame, label: str, score: str, normalised: bool = False, by=()) -> DataFrame:
    """``2 * auc - 1``; normalised divides by the value of a perfect score, which is 1 without fault.

    The label as its own score reaches an AUC of 1 whenever both classes occur.
    """
    by = list(by)
    own = roc_auc(df, label, score, by).select(*by, (2 * F.col("auc") - 1).alias("gini"))
    if not normalised:
        return own
    best = roc_auc(df.withColumn("_best", F.col(label).cast("double")), label, "_best", by)
    if not by:
        own, best = own.withColumn("_k", F.lit(1)), best.withColumn("_k", F.lit(1))
    joined = match_on(own, best, by or ["_k"])
    return joined.select(*by, (F.col("gini") / (2 * F.col("auc") - 1)).alias("gini"))


def average_precision(df: DataFrame, label: str, score: str, by=(), name: str = "ap") -> DataFrame:
    """Sum of precision times recall step over falling distinct scores; NaN without positives."""
    by = list(by)
    counts = _score_counts(df, label, score, by).withColumn("_all", F.col("pos") + F.col("neg"))
    cum = prefix_sums(counts, [F.col(score).desc()], {"tp": "pos", "seen": "_all"}, by)
    sums = cum.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("tp") / F.col("seen"))).alias("_area"), F.sum("pos").alias("_p")
    )
    area = F.when(F.col("_p") > 0, F.col("_area") / F.col("_p")).otherwise(F.lit(float("nan")))
    return sums.select(*by, area.alias(name))


def ap_above(df: DataFrame, label: str, score: str, threshold: float = 0.0, by=()) -> DataFrame:
    """Average precision over rows with a score above ``threshold`` or a positive label."""
    return average_precision(df.filter((F.col(score) > threshold) | (F.col(label) == 1)), label, score, by)


def mean_ap(aps: DataFrame, skip_nan: bool = True, without=None, by: str = "class_name") -> DataFrame:
    """Mean of the APs of the classes, without one class (such as background) on request."""
    rows = aps.filter(F.col(by) != without) if without is not None else aps
    value = F.when(~F.isnan("ap"), F.col("ap")) if skip_nan else F.col("ap")
    return rows.agg(F.avg(value).alias("map"))


def importance_sum(df: DataFrame, feature: str = "feature", importance: str = "importance") -> DataFrame:
    """Importance of each feature, summed over models."""
    return df.groupBy(feature).agg(F.sum(importance).alias("importance"))


def best_by(df: DataFrame, group, value: str, name: str = "best") -> DataFrame:
    return df.groupBy(*_as_list(group)).agg(F.min(value).alias(name))


def best_trial(df: DataFrame, score: str, order: str) -> DataFrame:
    """The row with the highest score, the earliest on ties."""
    return df.orderBy(F.col(score).desc(), F.col(order)).limit(1)


def throughput(runs: DataFrame, samples, run: str = "run", before: str = "before", after: str = "after") -> DataFrame:
    """Samples per second over timed runs, the first (slow) run left out when there are more."""
    took = F.col(after) - F.col(before)
    sums = runs.agg(
        F.count(F.lit(1)).alias("runs"), F.sum(took).alias("_all"), F.min_by(took, F.col(run)).alias("_first")
    )
    many = F.col("runs") > 1
    seconds = F.col("_all") - F.when(many, F.col("_first")).otherwise(F.lit(0.0))
    share = F.when(many, (F.col("runs") - 1) / F.col("runs")).otherwise(F.lit(1.0))
    speed = F.lit(float(samples)) * share / F.greatest(seconds, F.lit(1e-6))
    return sums.select("runs", F.when(F.col("runs") > 0, speed).alias("samples_per_sec"))


def eval_loss(df: DataFrame, label: str, score: str, kind: str, penalty: float = 0.0) -> DataFrame:
    """Mean ``l2``, ``log`` or ``hinge`` loss plus a penalty term given by the caller."""
    y, s = F.col(label).cast("double"), F.col(score)
    terms = {
        "l2": (y - s) * (y - s) / 2,
        "log": y * F.log1p(F.exp(-s)) + (1 - y) * F.log1p(F.exp(s)),
        "hinge": F.pow(F.greatest(1 - (2 * y - 1) * s, F.lit(0.0)), 2) / 4,
    }
    if kind not in terms:
        raise ValueError(f"unknown loss {kind}")
    return df.agg((F.avg(terms[kind]) + F.lit(penalty)).alias("loss"))


def vote_share(neighbours: DataFrame, classes, query: str = "query_id", label: str = "label") -> DataFrame:
    """Share of each class among a query's neighbours, with a 0 for absent classes."""
    counted = neighbours.groupBy(query).agg(
        F.count(F.lit(1)).alias("_k"), *[F.count_if(F.col(label) == F.lit(c)).alias(f"_c{i}") for i, c in enumerate(classes)]
    )
    shares = F.array(*[
        F.struct(F.lit(c).alias("class_name"), (F.col(f"_c{i}") / F.col("_k")).alias("score"))
        for i, c in enumerate(classes)
    ])
    return counted.select(query, F.explode(shares).alias("_s")).select(query, "_s.class_name", "_s.score")


def query_costs(neighbours: DataFrame, compat: bool = False, computed: DataFrame | None = None,
                query: str = "query_id", dist: str = "dist") -> DataFrame:
    """Mean over queries of their mean neighbour distance and of their distance computations.

    ``compat`` divides by queries + 1, the published running average's value.
    """
    per_query = neighbours.groupBy(query).agg(F.avg(dist).alias("_d"))
    if computed is not None:
        per_query = per_query.join(computed, query, "left")
    else:
        per_query = per_query.withColumn("n_computed", F.lit(None).cast("long"))
    n = F.count(F.lit(1)) + (1 if compat else 0)
    return per_query.agg(
        (F.sum("_d") / n).alias("average_distance"), (F.sum("n_computed") / n).alias("average_compute")
    )

