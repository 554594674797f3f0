"""Model data flow: searches, bagging, stacking, leaf features, hard negatives, scoring (boosted trees: ``boosting``).

Every fit is a distributed Spark ML fit; a loop on the driver only starts them.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    FMClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.keys import HASH_RANGE, match_on, md5_number, value_key
from tidewright.functions.vectors import log_mean_exp
from tidewright.operators.boosting import Boosted
from tidewright.operators.metrics import roc_auc, throughput
from tidewright.operators.order import _as_list, stratified_folds
from tidewright.operators.select import sample_n
from tidewright.operators.tabular import assemble
from tidewright.session import cut, scratch_path


def add_class_weight(df: DataFrame, label: str, positive_weight: float, name: str = "weight") -> DataFrame:
    """Weight of the rare positive class; 1 for the others."""
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0)))


# ---------------------------------------------------------------- searches


def _cross_validate(df, estimator, maps, label, key, folds, seed, parallelism):
    split = stratified_folds(df, label, key, folds, seed, "_fold").withColumn("_fold", F.col("_fold").cast("int"))
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    search = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=judge, numFolds=folds,
                            foldCol="_fold", parallelism=parallelism, seed=seed)
    fitted = search.fit(split)
    rows = [
        (i, *[float(v) for v in m.values()], float(score)) for i, (m, score) in enumerate(zip(maps, fitted.avgMetrics))
    ]
    names = ["trial", *[p.name for p in maps[0]], "auc"]
    return df.sparkSession.createDataFrame(rows, names), fitted.bestModel


def grid_search(df: DataFrame, estimator, grid: dict[str, list], label: str, key, folds: int = 5, seed: int = 0, parallelism: int = 2):
    """Mean AUC over folds for each combination; returns the trial table and the best model."""
    maps = [
        {estimator.getParam(n): v for n, v in zip(grid, combo)} for combo in product(*grid.values())
    ]
    return _cross_validate(df, estimator, maps, label, key, folds, seed, parallelism)


def random_search(df: DataFrame, estimator, space: dict[str, tuple], n: int, label: str, key, folds: int = 3, seed: int = 0, parallelism: int = 2):
    """``n`` seeded random trials; a range is ``(lo, hi, 'uniform' | 'log' | 'int')``."""
    rng = np.random.default_rng(seed)
    draw = {
        "uniform": lambda lo, hi: float(rng.uniform(lo, hi)),
        "log": lambda lo, hi: float(np.exp(rng.uniform(np.log(lo), np.log(hi)))),
        "int": lambda lo, hi: int(rng.integers(lo, hi + 1)),
    }
    maps = [{estimator.getParam(name): draw[kind](lo, hi) for name, (lo, hi, kind) in space.items()} for _ in range(n)]
    return _cross_validate(df, estimator, maps, label, key, folds, seed, parallelism)


# ---------------------------------------------------------------- bagging


def _poisson_weight(unit, mean: float):
    """Poisson count for a uniform number, by its distribution function."""
    limits, term, total, k = [], np.exp(-mean), 0.0, 0
    while total < 1 - 1e-12 and k < 60:
        total += term
        limits.append(total)
        k += 1
        term *= mean / k
    weight = F.lit(0)
    for limit in limits[:-1]:
        weight = weight + (unit >= F.lit(float(limit))).cast("int")
    return weight


def _amount(size, population: int) -> int:
    """A share (float) or a count (int) as a count between 1 and the population."""
    wanted = int(size * population) if isinstance(size, float) else int(size)
    if not 0 < wanted <= population:
        raise ValueError(f"sample size {size} must lie within (0, {population}]")
    return wanted


def bagging_plan(df: DataFrame, key, estimators, rows=1.0, replace: bool = True, seed: int = 0) -> DataFrame:
    """Multiplicity of each row in each estimator's sample, as ``(key, estimator, weight)`` rows above 0.

    ``estimators`` is a count or a list of numbers. Draws hash (seed, estimator,
    key), so an estimator has the same sample whenever it is asked for. With
    replacement the multiplicity is Poisson, which needs no shuffle; without,
    exactly the wanted number of rows is taken.
    """
    keys = _as_list(key)
    numbers = range(estimators) if isinstance(estimators, int) else estimators
    every = F.array(*[F.lit(e) for e in numbers])
    if replace:
        mean = rows if isinstance(rows, float) else rows / df.count()

        def draw(e):
            return F.struct(e.alias("estimator"), _row_weight(keys, e, mean, seed).alias("weight"))

        drawn = F.filter(F.transform(every, draw), lambda d: d["weight"] > 0)
        return df.select(*keys, F.explode(drawn).alias("_d")).select(*keys, "_d.*")
    spread = df.select(*keys, F.explode(every).alias("estimator"))
    wanted = _amount(rows, df.count())
    return sample_n(spread, wanted, "estimator", ["estimator", *keys], seed).withColumn("weight", F.lit(1))


def _row_weight(keys: list[str], estimator, mean: float, seed: int):
    """Poisson multiplicity of a row for one estimator."""
    unit = md5_number(value_key(seed, estimator, *keys)) / F.lit(float(HASH_RANGE))
    return F.transform(F.array(unit), lambda u: _poisson_weight(u, mean))[0]  # hashes once


def _drawn_weight(df: DataFrame, key, estimator: int, rows, seed: int):
    """The weight that ``bagging_plan`` with replacement gives a row of ``df``."""
    mean = rows if isinstance(rows, float) else rows / df.count()
    return _row_weight(_as_list(key), F.lit(estimator), mean, seed)


def feature_plan(features, estimator: int, cols=1.0, replace: bool = False, seed: int = 0) -> list[str]:
    """Feature subset of one estimator; column names are few and drawn on the driver."""
    rng = np.random.default_rng([seed, estimator])
    wanted = _amount(cols, len(features))
    picked = rng.integers(0, len(features), wanted) if replace else rng.permutation(len(features))[:wanted]
    return [features[i] for i in sorted(picked.tolist())]


@dataclass
class Ensemble:
    """Base models with their feature subsets and the plan they were drawn by."""

    models: list
    features: list[list[str]]
    settings: dict

    def scores(self, df: DataFrame, key) -> DataFrame:
        """Class probabilities of every base model: ``(key, estimator, probs)``; no shuffle."""
        keys = _as_list(key)
        rows = F.array(*[F.struct(F.lit(i).alias("estimator"), F.col(f"_v{i}").alias("probs")) for i in range(len(self.models))])
        return self._wide(df, keys).select(*keys, F.explode(rows).alias("_s")).select(*keys, "_s.*")

    def _wide(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """Keys and the probability array ``_v<i>`` of each base model, side by side on the row."""
        out = df
        for i, (model, cols) in enumerate(zip(self.models, self.features)):
            model.setFeaturesCol("_x").setPredictionCol(f"_c{i}").setProbabilityCol(f"_p{i}").setRawPredictionCol("_r")
            unique = list(dict.fromkeys(cols))
            out = model.transform(assemble(out, unique, "_x")).drop("_x", "_r", f"_c{i}")
        return out.select(*keys, *[vector_to_array(f"_p{i}").alias(f"_v{i}") for i in range(len(self.models))])

    def predict_proba(self, df: DataFrame, key) -> DataFrame:
        """Mean probability of each class, taken on the row: no shuffle. The key names rows, so it is unique."""
        keys = _as_list(key)
        classes = max(model.numClasses for model in self.models)
        means = []
        for c in range(classes):
            parts = [F.get(f"_v{i}", F.lit(c)) for i in range(len(self.models))]
            known = sum((p.isNotNull().cast("int") for p in parts), F.lit(0))
            means.append(sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)) / known)
        wide = self._wide(df, keys).select(*keys, F.array(*means).alias("_means"))
        return wide.select(*keys, F.posexplode("_means").alias("class_index", "p"))

    def predict(self, df: DataFrame, key) -> DataFrame:
        return ensemble_class(self.predict_proba(df, key))

    def log_proba(self, df: DataFrame, key) -> DataFrame:
        """Log of the mean probability of each class, taken on the row."""
        proba = self.predict_proba(df, key)
        log = F.when(F.col("p") > 0, F.log("p")).otherwise(F.lit(float("-inf")))
        return proba.select(*_as_list(key), "class_index", log.alias("log_p"))

    def oob(self, df: DataFrame, key, label: str) -> tuple[DataFrame, DataFrame]:
        """Out-of-bag shares and AUC as the function ``oob`` gives them, from probabilities and draws that lie on the row: no shuffle but for the AUC.

        For ensembles drawn with replacement, whose draws are an expression on the key.
        """
        if not self.settings["replace"]:
            raise ValueError("draws without replacement are not on the row; use oob with the plan")
        keys = _as_list(key)
        mean = self.settings["rows"] if isinstance(self.settings["rows"], float) else self.settings["rows"] / df.count()
        numbers = range(len(self.models))
        outside = [_row_weight(keys, F.lit(e), mean, self.settings["seed"]) == 0 for e in numbers]
        sums = [
            sum((F.when(out, F.get(f"_v{e}", F.lit(c))).otherwise(0.0) for e, out in zip(numbers, outside)), F.lit(0.0)) for c in (0, 1)
        ]
        wide = self._wide(df, [*keys, label]).select(*keys, label, sums[0].alias("_s0"), sums[1].alias("_s1"))
        return _oob_table(wide, keys, label)

    def extend(self, df: DataFrame, more: int) -> Ensemble:
        """Add estimators; the present ones stay and new numbers continue the seeds."""
        start = len(self.models)
        added = fit_bagging(df, estimators=range(start, start + more), **self.settings)
        return Ensemble(self.models + added.models, self.features + added.features, self.settings)


def fit_bagging(df: DataFrame, features, label: str, key, estimators=10, rows=1.0, cols=1.0, replace: bool = True,
                replace_cols: bool = False, seed: int = 0, depth: int = 5) -> Ensemble:
    """A decision tree for each estimator, on its weighted rows and its features."""
    numbers = list(range(estimators) if isinstance(estimators, int) else estimators)
    settings = dict(features=list(features), label=label, key=key, rows=rows, cols=cols, replace=replace,
                    replace_cols=replace_cols, seed=seed, depth=depth)
    models, subsets = [], []
    for e in numbers:
        subset = feature_plan(list(features), e, cols, replace_cols, seed)
        if replace:  # the multiplicity is an expression on the row: no join
            weighted = df.withColumn("_w", _drawn_weight(df, key, e, rows, seed).cast("double")).filter("_w > 0")
        else:
            plan = bagging_plan(df, key, [e], rows, replace, seed)
            weighted = match_on(df, plan.drop("estimator"), _as_list(key)).withColumn("_w", F.col("weight").cast("double"))
        data = assemble(weighted.withColumn("_y", F.col(label).cast("double")), list(dict.fromkeys(subset)), "_x")
        tree = DecisionTreeClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", maxDepth=depth, seed=seed + e)
        models.append(tree.fit(data))
        subsets.append(subset)
    return Ensemble(models, subsets, settings)


def mean_proba(scores: DataFrame, key) -> DataFrame:
    """Mean class probabilities over estimators, from ``(key, estimator, probs)``."""
    keys = _as_list(key)
    classes = scores.select(*keys, F.posexplode("probs").alias("class_index", "p"))
    return classes.groupBy(*keys, "class_index").agg(F.avg("p").alias("p"))


def vote_proba(predictions: DataFrame, key, prediction: str = "prediction") -> DataFrame:
    """Share of the estimators that chose each class, for models without probabilities."""
    keys = _as_list(key)
    counts = predictions.groupBy(*keys, F.col(prediction).cast("int").alias("class_index")).agg(F.count(F.lit(1)).alias("_n"))
    totals = predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    return match_on(counts, totals, keys).select(*keys, "class_index", (F.col("_n") / F.col("_all")).alias("p"))


def ensemble_class(proba: DataFrame) -> DataFrame:
    """The most probable class, the smaller number on ties."""
    keys = [c for c in proba.columns if c not in ("class_index", "p")]
    best = proba.groupBy(*keys).agg(F.max(F.struct("p", -F.col("class_index"))).alias("_b"))
    return best.select(*keys, (-F.col("_b.col2")).alias("prediction"))


def mean_log_proba(scores: DataFrame, key) -> DataFrame:
    """Log of the mean probability, from log probabilities and shifted by the largest."""
    keys = _as_list(key)
    classes = scores.select(*keys, F.posexplode("probs").alias("class_index", "p"))
    logs = classes.groupBy(*keys, "class_index").agg(F.collect_list(F.coalesce(F.log("p"), F.lit(float("-inf")))).alias("_l"))
    return logs.select(*keys, "class_index", log_mean_exp("_l").alias("log_p"))  # one entry per estimator


def mean_decision(scores: DataFrame, key, decision: str = "decision") -> DataFrame:
    return scores.groupBy(*_as_list(key)).agg(F.avg(decision).alias("decision"))


mean_rounds = mean_decision


def oob(scores: DataFrame, plan: DataFrame, labels: DataFrame, key, label: str) -> tuple[DataFrame, DataFrame]:
    """Out-of-bag class shares per row, and the AUC of the summed class-1 score.

    The AUC uses the sums, not the shares, as the published score does. A row
    drawn by every estimator has no share and ``has_oob`` is false.
    """
    keys = _as_list(key)
    outside = scores.join(plan.select(*keys, "estimator"), [*keys, "estimator"], "left_anti")
    sums = outside.groupBy(*keys).agg(
        F.sum(F.col("probs")[0]).alias("_s0"), F.sum(F.col("probs")[1]).alias("_s1")
    )
    return _oob_table(labels.select(*keys, label).join(sums, keys, "left").fillna(0.0, ["_s0", "_s1"]), keys, label)


def _oob_table(rows: DataFrame, keys: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Shares and AUC from the summed probabilities ``_s0`` and ``_s1`` of each row."""
    total = F.col("_s0") + F.col("_s1")
    table = rows.select(
        *keys, label, (total > 0).alias("has_oob"), F.col("_s1").alias("score"), F.try_divide("_s1", total).alias("p")
    )
    return table, roc_auc(table, label, "score", name="oob_auc")


# ---------------------------------------------------------------- stacking and leaves


@dataclass
class Stack:
    model: object
    cols: list[str]

    def transform(self, df: DataFrame, compat: bool = False, name: str = "p") -> DataFrame:
        """Stacked probability; ``compat`` is the plain product with the coefficients."""
        linear = F.lit(0.0)
        for c, w in zip(self.cols, self.model.coefficients.toArray()):
            linear = linear + F.col(c) * float(w)
        if compat:
            return df.withColumn(name, linear)
        return df.withColumn(name, 1 / (1 + F.exp(-(linear + float(self.model.intercept)))))


def fit_stack(scores: DataFrame, cols, label: str, c: float = 1e6) -> Stack:
    """Logistic regression on the scores of the base models."""
    data = assemble(scores.withColumn("_y", F.col(label).cast("double")), cols, "_x")
    model = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=1.0 / c, maxIter=100).fit(data)
    return Stack(model, list(cols))


def leaf_features(df: DataFrame, model: Boosted, name: str = "leaves") -> DataFrame:
    """The leaf a row reaches in each tree, as one sparse one-hot vector."""
    counts = model.leaf_counts
    starts = [sum(counts[:i]) for i in range(len(counts))]
    places = F.transform(F.arrays_zip(F.col("_l").alias("leaf"), F.array(*[F.lit(s) for s in starts]).alias("start")), lambda p: p["leaf"] + p["start"])
    sparse = F.udf(lambda at, size=sum(counts): Vectors.sparse(size, at, [1.0] * len(at)), VectorUDT())
    return model.leaves(df, "_l").withColumn(name, sparse(places)).select(*df.columns, name)


def fit_fm(df: DataFrame, label: str, features: str = "leaves", factors: int = 5, max_iter: int = 50, seed: int = 0):
    """Factorisation machine on sparse features."""
    data = df.withColumn("_y", F.col(label).cast("double"))
    return FMClassifier(featuresCol=features, labelCol="_y", factorSize=factors, maxIter=max_iter, stepSize=0.01, seed=seed).fit(data)


# ---------------------------------------------------------------- hard negatives

# Published settings of the mining rounds, defaults of the parameters below.
POSITIVES, POOL_LIMIT = 25_000, 30_000


def pool_size(n: int, pool_limit: int = POOL_LIMIT) -> int:
    """Rows of the random pool: five per positive, one and a half where that would reach ``pool_limit``."""
    return 5 * n if 5 * n < pool_limit else int(1.5 * n)


def hard_negatives(scored: DataFrame, score: str, key, n: int) -> DataFrame:
    """The ``n`` negatives with the highest scores."""
    return scored.orderBy(F.col(score).desc(), *_as_list(key)).limit(n)


def mine_negatives(negatives: DataFrame, score, key, n: int, seed: int, pool_limit: int = POOL_LIMIT) -> DataFrame:
    """Next training negatives: the hardest ``n`` of a random pool and ``n`` random ones.

    ``score`` adds a column ``_score`` to a frame. A row may be drawn twice, as hard and as random.
    """
    everyone = negatives.withColumn("_all", F.lit(0))
    pool = sample_n(everyone, pool_size(n, pool_limit), "_all", key, seed).drop("_all")
    hard = hard_negatives(score(pool), "_score", key, n).select(*negatives.columns)
    rnd = sample_n(everyone, n, "_all", key, seed + 1).select(*negatives.columns)
    return hard.unionByName(rnd)


def one_class(df: DataFrame, features: str, label: str, key, rounds: int = 10, seed: int = 0, reg: float = 0.01,
              positives_for_fit: int | None = POSITIVES, pool_limit: int = POOL_LIMIT) -> list:
    """A linear hinge-loss model for each mining round of one class; ``features`` is a vector column.

    ``positives_for_fit`` bounds the labelled positives of a fit (None: all), ``pool_limit`` is the switch of ``pool_size``; the
    defaults are the published settings.
    """
    data = df.select(*_as_list(key), features, F.col(label).cast("double").alias("_y"))
    everyone = data.withColumn("_all", F.lit(0))
    found = everyone.filter("_y > 0")
    positives = cut((found if positives_for_fit is None else sample_n(found, positives_for_fit, "_all", key, seed)).drop("_all"))
    negatives = data.filter("_y = 0")
    n = positives.count()
    current = sample_n(everyone.filter("_y = 0"), 2 * n, "_all", key, seed).drop("_all")
    models = []
    for r in range(rounds):
        train = cut(positives.unionByName(current))
        model = LinearSVC(featuresCol=features, labelCol="_y", regParam=reg, maxIter=50).fit(train)
        models.append(model)

        def score(frame, model=model):
            return model.transform(frame).withColumn("_score", vector_to_array("rawPrediction")[1])

        current = mine_negatives(negatives, score, key, n, seed + 2 * (r + 1), pool_limit)
    return models


# ---------------------------------------------------------------- scoring


def score_table(df: DataFrame, model, key, runs: int = 2) -> tuple[DataFrame, DataFrame]:
    """Score a table in ``runs`` timed parts; returns the scored rows and the throughput."""
    spark = df.sparkSession
    path = scratch_path(spark, "scores")
    scored = model.transform(df)
    keep = [c for c, t in scored.dtypes if t != "vector"]
    part = F.pmod(F.xxhash64(*_as_list(key)), F.lit(runs))
    log = []
    for run in range(runs):
        start = time.time()
        scored.filter(part == run).select(*keep).write.mode("append").parquet(path)
        log.append((run, start, time.time()))
    out = spark.read.parquet(path)
    timed = spark.createDataFrame(log, "run int, before double, after double")
    return out, throughput(timed, out.count())


def trial_table(trials: DataFrame) -> DataFrame:
    """Trials with the best score up to each; trials are few."""
    window = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best_auc", F.max("auc").over(window))
