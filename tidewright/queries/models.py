"""Model data flow: plans and ensemble arithmetic with SQL, fits by row count."""

from pyspark.sql import functions as F

from tidewright.operators.boosting import Boosted, boosted_grid, fit_boosted, fit_chunks, guided_search
from tidewright.operators.ensemble import (
    Ensemble,
    add_class_weight,
    bagging_plan,
    ensemble_class,
    fit_bagging,
    fit_fm,
    fit_stack,
    leaf_features,
    mean_decision,
    mean_log_proba,
    mean_proba,
    mean_rounds,
    mine_negatives,
    one_class,
    oob,
    score_table,
    trial_table,
    vote_proba,
)
from tidewright.operators.order import stratified_folds, with_chunk_id
from tidewright.queries.fixtures import model_scores, rounded, table, vectors, with_
from tidewright.queries.registry import query

FEATURES = ["value", "hour", "k", "device"]


def _events(spark, folder):
    """Events as a training table; the label follows the value, with noise."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), "value", F.hour("ts").alias("hour"), F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        (F.col("event_id") % 3).alias("device"),
        ((F.col("value") + F.col("event_id") * 37 % 50) > 60).cast("int").alias("y"),
    )


_U = "('0x' || substr(md5('{seed}:' || e || ':' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def _poisson(mean: float) -> str:
    import math

    limits, term, total, k = [], math.exp(-mean), 0.0, 0
    while total < 1 - 1e-12 and k < 60:
        total += term
        limits.append(total)
        k += 1
        term *= mean / k
    return " + ".join(f"CAST(u >= {limit!r}::DOUBLE AS INTEGER)" for limit in limits[:-1])


_PLAN = f"plan AS (SELECT o_orderkey, e AS estimator, {_poisson(0.8)} AS weight FROM (SELECT o_orderkey, CAST(e AS INTEGER) AS e, {_U.format(seed=21)} AS u FROM orders, range(3) t(e)))"


@query(f"WITH {_PLAN} SELECT o_orderkey, estimator, CAST(weight AS INTEGER) AS weight FROM plan WHERE weight > 0")
def bootstrap_plan(spark, folder):
    return bagging_plan(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 3, 0.8, True, 21)


@query("""SELECT o_orderkey, CAST(e AS INTEGER) AS estimator, CAST(1 AS INTEGER) AS weight FROM (SELECT o_orderkey, e, row_number() OVER (PARTITION BY e
      ORDER BY ('0x' || substr(md5('22:' || e || ':' || o_orderkey), 1, 8))::BIGINT, e, o_orderkey) AS rn, count(*) OVER (PARTITION BY e) AS n FROM orders, range(2) t(e))
    WHERE rn <= CAST(floor(0.6 * n) AS BIGINT)""")
def subsample_plan(spark, folder):
    return bagging_plan(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 2, 0.6, False, 22)


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 20.0::DOUBLE ELSE 1.0 END AS weight FROM labels")
def class_weights(spark, folder):
    return add_class_weight(table(spark, folder, "labels"), "toxic", 20).select("doc_id", "weight")


@query(with_("model_scores", """SELECT row_id, CAST(c AS INTEGER) AS class_index, round(avg(CASE WHEN c = 1 THEN p ELSE 1 - p END), 9) AS p FROM model_scores, range(2) t(c) GROUP BY ALL"""))
def mean_probabilities(spark, folder):
    return rounded(mean_proba(model_scores(spark, folder), "row_id"), 9)


@query(with_("model_scores", """SELECT row_id, CAST(CASE WHEN avg(p) > avg(1 - p) THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM model_scores GROUP BY row_id"""))
def ensemble_classes(spark, folder):
    return ensemble_class(mean_proba(model_scores(spark, folder), "row_id"))


@query(with_("model_scores", """SELECT row_id, CAST(c AS INTEGER) AS class_index, round(ln(avg(CASE WHEN c = 1 THEN p ELSE 1 - p END)), 9) AS log_p FROM model_scores, range(2) t(c) GROUP BY ALL"""))
def mean_log_probabilities(spark, folder):
    return rounded(mean_log_proba(model_scores(spark, folder), "row_id"), 9)


@query(with_("model_scores", """SELECT row_id, CAST(p > 0.5 AS INTEGER) AS class_index, round(count(*) / 3.0::DOUBLE, 9) AS p FROM model_scores GROUP BY ALL"""))
def vote_shares_of_models(spark, folder):
    votes = model_scores(spark, folder).withColumn("prediction", (F.col("probs")[1] > 0.5).cast("int"))
    return rounded(vote_proba(votes, "row_id"), 9)


@query(with_("model_scores", "SELECT row_id, round(avg(ln(p / (1 - p))), 9) AS decision FROM model_scores GROUP BY row_id"))
def mean_decision_values(spark, folder):
    scored = model_scores(spark, folder).withColumn("decision", F.log(F.col("probs")[1] / F.col("probs")[0]))
    return rounded(mean_decision(scored, "row_id"), 9)


@query(with_("model_scores", "SELECT row_id, round(avg(p), 9) AS decision FROM model_scores GROUP BY row_id"))
def mean_of_rounds(spark, folder):
    return rounded(mean_rounds(model_scores(spark, folder).withColumn("decision", F.col("probs")[1]), "row_id"), 9)


_OOB = with_("model_scores", f""", {_PLAN}, used AS (SELECT o_orderkey AS row_id, estimator FROM plan WHERE weight > 0),
    outside AS (SELECT s.* FROM model_scores s ANTI JOIN used u ON s.row_id = u.row_id AND s.estimator = u.estimator),
    rows_ AS (SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, coalesce(sum(p), 0.0::DOUBLE) AS s1, coalesce(sum(1 - p), 0.0::DOUBLE) AS s0
      FROM orders LEFT JOIN outside ON o_orderkey = row_id GROUP BY ALL)""")


def _oob(spark, folder):
    orders = table(spark, folder, "orders").selectExpr("o_orderkey as row_id", "cast(o_orderstatus = 'F' as int) as y")
    plan = bagging_plan(orders.select("row_id"), "row_id", 3, 0.8, True, 21)
    return oob(model_scores(spark, folder), plan, orders, "row_id", "y")


@query(_OOB + " SELECT row_id, y, s0 + s1 > 0 AS has_oob, round(s1, 9) AS score, round(CASE WHEN s0 + s1 > 0 THEN s1 / (s0 + s1) END, 9) AS p FROM rows_")
def out_of_bag_shares(spark, folder):
    return rounded(_oob(spark, folder)[0], 9)


@query(_OOB + """, r AS (SELECT y, s1 AS s FROM rows_), ranked AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS rk FROM r)
    SELECT round((sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0::DOUBLE)
      / (count(*) FILTER (WHERE y = 1) * CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE)), 5) AS oob_auc FROM ranked""")
def out_of_bag_auc(spark, folder):
    return rounded(_oob(spark, folder)[1], 5)


_EVENT_HASH = "('0x' || substr(md5('{seed}:' || event_id), 1, 8))::BIGINT"


@query(f"""WITH neg AS (SELECT event_id, value FROM events WHERE event_type <> 'purchase'),
    size AS (SELECT count(*) AS n, CASE WHEN 5 * count(*) < 30000 THEN 5 * count(*) ELSE CAST(floor(1.5 * count(*)) AS BIGINT) END AS pool FROM events WHERE event_type = 'purchase'),
    pool AS (SELECT * FROM neg QUALIFY row_number() OVER (ORDER BY {_EVENT_HASH.format(seed=31)}, event_id) <= (SELECT pool FROM size)),
    hard AS (SELECT * FROM pool QUALIFY row_number() OVER (ORDER BY value DESC, event_id) <= (SELECT n FROM size)),
    rnd AS (SELECT * FROM neg QUALIFY row_number() OVER (ORDER BY {_EVENT_HASH.format(seed=32)}, event_id) <= (SELECT n FROM size))
    SELECT * FROM hard UNION ALL SELECT * FROM rnd""")
def mined_negatives(spark, folder):
    """One mining step for all positives: as many hard ones of a random pool, and as many random ones."""
    events = table(spark, folder, "events")
    negatives = events.filter("event_type <> 'purchase'").select("event_id", "value")
    positives = events.filter("event_type = 'purchase'").count()
    return mine_negatives(negatives, lambda f: f.withColumn("_score", F.col("value")), "event_id", positives, 31)


_FITTED: dict[tuple[str, str], Boosted] = {}


def _fitted(spark, folder, anew: bool = False) -> Boosted:
    """The model of published settings for the events of a folder: five folds, stopped fifty rounds after the best mean AUC. Fitted once a session."""
    key = (spark.sparkContext.applicationId, folder)
    if anew or key not in _FITTED:
        _FITTED[key] = fit_boosted(_events(spark, folder), FEATURES, "y", "id")
    return _FITTED[key]


@query()
def boosted_probabilities(spark, folder):
    return _fitted(spark, folder, anew=True).transform(_events(spark, folder)).select("id", "p", "prediction")


# The three published grids.
GRIDS = [
    [{"leaves": n, "min_curvature": float(w)} for n in range(20, 100, 20) for w in range(1, 6, 2)],
    [{"leaves": n, "min_curvature": float(w)} for n in range(20, 40, 5) for w in range(10, 20, 2)],
    [{"leaves": 25, "min_curvature": 10.0, "min_gain": float(g)} for g in range(0, 20, 5)],
]


@query()
def grid_search_trials(spark, folder):
    """All points of the three grids on five folds, each with the published number of rounds, in shared passes."""
    return boosted_grid(_events(spark, folder), FEATURES, "y", "id", [p for grid in GRIDS for p in grid])[0]


# The published ranges; ``depth`` ends at 8, as a level has all its nodes.
SPACE = {
    "step": (0.01, 1.0, "log"), "leaves": (3, 100, "int"), "depth": (2, 8, "int"), "min_rows": (0, 50, "int"), "columns": (0.01, 1.0, "uniform"),
    "min_curvature": (0.0, 10.0, "uniform"), "l2": (1e-9, 10.0, "log"), "positive_weight": (50.0, 500.0, "log"),
}


@query()
def random_search_trials(spark, folder):
    """Twenty trials on three folds: a random batch, then batches drawn by the trials before; the worse half stops at 50 rounds, the least published number, the others at 100."""
    return trial_table(guided_search(_events(spark, folder), FEATURES, "y", "id", SPACE, halving=(50,))[0])


@query()
def bagged_probabilities(spark, folder):
    df = _events(spark, folder)
    ensemble: Ensemble = fit_bagging(df, FEATURES, "y", "id", estimators=9, rows=0.8, cols=0.75)
    return ensemble.extend(df, 1).predict_proba(df, "id")


@query()
def chunk_model_stack(spark, folder):
    """One model per chunk, their scores stacked on chunk 0."""
    df = with_chunk_id(_events(spark, folder), table(spark, folder, "events").count() // 3 + 1, ["id"]).withColumn("chunk", F.col("chunk").cast("int"))
    models = fit_chunks(df, FEATURES, "y")
    scored = df
    for i, model in enumerate(models):
        scored = model.transform(scored, f"p{i}").drop("prediction")
    cols = [f"p{i}" for i in range(len(models))]
    stack = fit_stack(scored.filter("chunk = 0"), cols, "y")
    return stack.transform(scored).select("id", "p")


@query()
def leaf_factorisation(spark, folder):
    df = _events(spark, folder)
    leaves = leaf_features(df, _fitted(spark, folder))
    model = fit_fm(leaves, "y")
    return model.transform(leaves).select("id", F.col("prediction").cast("int").alias("prediction"))


@query()
def mined_class_scores(spark, folder):
    """Models of the ten mining rounds for label 3, and the mean of their scores."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    df = vectors(spark, folder).select("vec_id", array_to_vector(F.col("vec").cast("array<double>")).alias("features"), (F.col("label") == 3).cast("int").alias("y"))
    scored = df
    models = one_class(df, "features", "y", "vec_id")
    for i, model in enumerate(models):
        scored = model.transform(scored).withColumn(f"s{i}", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "prediction")
    rounds = scored.select("vec_id", F.explode(F.array(*[f"s{i}" for i in range(len(models))])).alias("decision"))
    return mean_rounds(rounds, "vec_id")


@query()
def scored_table(spark, folder):
    df = _events(spark, folder)
    return score_table(df, _fitted(spark, folder), "id")[0].select("id", "p")


@query("SELECT count(*) AS samples, true AS timed FROM events")
def scoring_throughput(spark, folder):
    """Rows that were scored, and whether the timed parts gave a throughput; its value is the machine's."""
    scored, speed = score_table(_events(spark, folder), _fitted(spark, folder), "id")
    return scored.agg(F.count("*").alias("samples")).withColumn("timed", F.lit(speed.first().samples_per_sec > 0))


@query("""SELECT event_id, event_type, (row_number() OVER (PARTITION BY event_type ORDER BY md5('13:' || event_id), event_id) - 1) % 3 AS fold FROM events""")
def event_folds(spark, folder):
    return stratified_folds(table(spark, folder, "events").select("event_id", "event_type"), "event_type", "event_id", 3, 13)
