"""Metrics, ranks, folds, batches and samples."""

from pyspark.sql import functions as F

from tidewright.operators.metrics import (
    ap_above,
    average_precision,
    best_by,
    best_trial,
    confusion,
    eval_loss,
    gini,
    importance_sum,
    mean_ap,
    roc_auc,
    top_k_accuracy,
)
from tidewright.operators.joins import for_each_param
from tidewright.operators.order import (
    batches,
    cap_candidates,
    eval_rows,
    head,
    interleave,
    k_best,
    newest,
    row_index,
    shuffle,
    sort,
    stratified_folds,
    top_features,
    with_chunk_id,
)
from tidewright.operators.select import sample_fraction, sample_n, thin_candidates
from tidewright.queries.fixtures import rounded, table, vectors
from tidewright.queries.registry import query

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_KEY = ", ".join(LINE_KEY)
_H = "('0x' || substr(md5({}), 1, 8))::BIGINT"

_SCORED = """scored AS (SELECT l_suppkey % 7 AS g, CAST(l_returnflag = 'R' AS INTEGER) AS y,
    round(l_quantity / 50 + l_discount, 2) AS s FROM lineitem)"""


def _scored(spark, folder):
    return table(spark, folder, "lineitem").select(
        (F.col("l_suppkey") % 7).alias("g"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.round(F.col("l_quantity") / 50 + F.col("l_discount"), 2).alias("s"),
    )


_AUC = """ranked AS (SELECT *, rank() OVER (PARTITION BY {g} ORDER BY s) + (count(*) OVER (PARTITION BY {g}, s) - 1) / 2.0::DOUBLE AS r FROM scored),
    aucs AS (SELECT {g} AS g, (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0::DOUBLE)
      / (count(*) FILTER (WHERE y = 1) * CAST(count(*) FILTER (WHERE y <> 1) AS DOUBLE)) AS auc FROM ranked GROUP BY {g})"""
_AP = """levels AS (SELECT {g} AS g, s, count(*) FILTER (WHERE y = 1) AS pos, count(*) AS n FROM scored {where} GROUP BY {g}, s),
    cum AS (SELECT g, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM levels WINDOW w AS (PARTITION BY g ORDER BY s DESC)),
    aps AS (SELECT g, sum(pos * (CAST(tp AS DOUBLE) / seen)) / sum(pos) AS ap FROM cum GROUP BY g)"""


@query(f"WITH {_SCORED}, {_AUC.format(g='1')} SELECT round(auc, 9) AS auc FROM aucs".replace("PARTITION BY 1, s", "PARTITION BY s").replace("PARTITION BY 1 ORDER", "ORDER"))
def auc_all(spark, folder):
    return rounded(roc_auc(_scored(spark, folder), "y", "s"), 9)


@query(f"WITH {_SCORED}, {_AUC.format(g='g')} SELECT g, round(auc, 9) AS auc FROM aucs")
def auc_by_group(spark, folder):
    return rounded(roc_auc(_scored(spark, folder), "y", "s", ["g"]), 9)


@query(f"WITH {_SCORED}, {_AUC.format(g='g')} SELECT g, round(2 * auc - 1, 9) AS gini FROM aucs")
def gini_by_group(spark, folder):
    return rounded(gini(_scored(spark, folder), "y", "s", normalised=True, by=["g"]), 9)


@query(f"WITH {_SCORED}, {_AP.format(g='g', where='')} SELECT g, round(ap, 9) AS ap FROM aps")
def average_precision_by_group(spark, folder):
    return rounded(average_precision(_scored(spark, folder), "y", "s", ["g"]), 9)


@query(f"WITH {_SCORED}, {_AP.format(g='g', where='WHERE s > 0.5 OR y = 1')} SELECT round(avg(ap), 9) AS map FROM aps WHERE g <> 6")
def mean_average_precision(spark, folder):
    aps = ap_above(_scored(spark, folder), "y", "s", 0.5, ["g"])
    return rounded(mean_ap(aps, without=6, by="g"), 9)


@query(f"""WITH {_SCORED}, judged AS (SELECT y, CAST(s > 0.5 AS INTEGER) AS p FROM scored)
    SELECT count(*) AS n, round(avg(CAST(y = p AS DOUBLE)), 9) AS accuracy,
      round(count(*) FILTER (WHERE y = 1 AND p = 0) / CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE), 9) AS type_2,
      round(count(*) FILTER (WHERE y = 0 AND p = 1) / CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE), 9) AS type_1 FROM judged""")
def confusion_counts(spark, folder):
    judged = _scored(spark, folder).withColumn("p", (F.col("s") > 0.5).cast("int"))
    return rounded(confusion(judged, "y", "p"), 9)


@query("""SELECT count(*) AS n, round(avg(CAST(len(list_filter(embedding, lambda v: v > embedding[label + 1])) < 5 AS DOUBLE)), 9) AS top_5 FROM embeddings""")
def top_five_accuracy(spark, folder):
    return rounded(top_k_accuracy(vectors(spark, folder), "label", "vec", 5), 9)


@query(f"""WITH {_SCORED} SELECT round(avg((y - s) * (y - s) / 2), 9) AS l2,
    round(avg(y * ln(1 + exp(-s)) + (1 - y) * ln(1 + exp(s))), 9) AS log,
    round(avg(pow(greatest(1 - (2 * y - 1) * s, 0), 2) / 4), 9) AS hinge FROM scored""")
def evaluation_losses(spark, folder):
    scored = _scored(spark, folder)
    losses = {k: eval_loss(scored, "y", "s", k).select(F.lit(k).alias("kind"), "loss") for k in ("l2", "log", "hinge")}
    stacked = losses["l2"].unionByName(losses["log"]).unionByName(losses["hinge"])
    return rounded(stacked.groupBy().pivot("kind", ["l2", "log", "hinge"]).agg(F.first("loss")), 9)


@query("""WITH grid AS (SELECT * FROM (VALUES (0, 5.0::DOUBLE, 0.1::DOUBLE), (1, 5.0, 0.2), (2, 10.0, 0.1), (3, 10.0, 0.2)) t(trial, weight, shift)),
    losses AS (SELECT trial, weight, shift, avg(weight * pow(CAST(l_returnflag = 'R' AS INTEGER) - l_discount - shift, 2)) AS err FROM lineitem, grid GROUP BY trial, weight, shift)
    SELECT weight, round(min(err), 9) AS best FROM losses GROUP BY weight""")
def least_error_per_weight(spark, folder):
    lines = table(spark, folder, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), "l_discount")
    tried = for_each_param(lines, {"weight": [5.0, 10.0], "shift": [0.1, 0.2]})
    errors = tried.groupBy("trial", "weight", "shift").agg(
        F.avg(F.col("weight") * F.pow(F.col("y") - F.col("l_discount") - F.col("shift"), F.lit(2))).alias("err")
    )
    return rounded(best_by(errors, "weight", "err"), 9)


@query("""SELECT * FROM (SELECT user_id AS trial, round(avg(value), 6) AS score FROM events GROUP BY user_id) ORDER BY score DESC, trial LIMIT 1""")
def best_trial_row(spark, folder):
    trials = table(spark, folder, "events").groupBy(F.col("user_id").alias("trial")).agg(F.round(F.avg("value"), 6).alias("score"))
    return best_trial(trials, "score", "trial")


@query("SELECT event_type AS feature, round(sum(value), 4) AS importance FROM events GROUP BY event_type")
def importance_over_models(spark, folder):
    rows = table(spark, folder, "events").select(F.col("event_type").alias("feature"), F.col("value").alias("importance"))
    return rounded(importance_sum(rows), 4)


@query(f"SELECT {_KEY}, (row_number() OVER (ORDER BY {_KEY}) - 1) // 7000 AS chunk FROM lineitem")
def chunk_numbers(spark, folder):
    return with_chunk_id(table(spark, folder, "lineitem").select(*LINE_KEY), 7000, LINE_KEY)


@query(f"""SELECT {_KEY}, batch FROM (SELECT {_KEY}, (row_number() OVER (ORDER BY {_KEY}) - 1) // 256 AS batch, count(*) OVER () AS n FROM lineitem)
    WHERE batch < n // 256""")
def full_batches(spark, folder):
    return batches(table(spark, folder, "lineitem").select(*LINE_KEY), 256, LINE_KEY)


@query("""SELECT o_orderkey, batch FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 128 AS batch, count(*) OVER () AS n FROM orders)
    WHERE batch < least(n // 128, n // 200)""")
def evaluated_batches(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return eval_rows(orders, 128, orders.count() // 200, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "batch")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def first_rows(spark, folder):
    return head(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 100, [F.desc("o_totalprice"), "o_orderkey"])


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def newest_batch(spark, folder):
    return newest(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 100, "o_orderkey")


@query("SELECT DISTINCT user_id FROM events ORDER BY user_id")
def sorted_ids(spark, folder):
    return sort(table(spark, folder, "events").select("user_id").distinct(), "user_id")


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 5""")
def k_best_per_user(spark, folder):
    return k_best(table(spark, folder, "events").select("user_id", "event_id", "value"), "user_id", "value", "event_id", 5)


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 10""")
def capped_candidates(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "ts")
    return cap_candidates(events, "user_id", ["ts", "event_id"], 10).select("user_id", "event_id")


@query("""SELECT p_brand || ':' || p_type AS feature, round(avg(p_retailprice), 6) AS score FROM part GROUP BY 1 ORDER BY score DESC, feature LIMIT 40""")
def best_features(spark, folder):
    part = table(spark, folder, "part").groupBy(F.concat_ws(":", "p_brand", "p_type").alias("feature")).agg(F.round(F.avg("p_retailprice"), 6).alias("score"))
    return top_features(part, "score", 40)


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('5:' || doc_id), doc_id) - 1 AS place FROM documents")
def shuffled_documents(spark, folder):
    """Random order that is the same on every run, shown as a place."""
    docs = table(spark, folder, "documents").select("doc_id")
    return row_index(docs, [F.md5(F.concat(F.lit("5:"), F.col("doc_id").cast("string"))), "doc_id"], "place")


@query("SELECT doc_id, lang FROM documents")
def shuffle_rows(spark, folder):
    return shuffle(table(spark, folder, "documents").select("doc_id", "lang"), 5, "doc_id")


@query("""SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY md5('11:' || doc_id), doc_id) - 1) % 5 AS fold FROM labels""")
def label_folds(spark, folder):
    return stratified_folds(table(spark, folder, "labels").select("doc_id", "quality"), "quality", "doc_id", 5, 11)


@query("""WITH turns AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS turn FROM orders)
    SELECT o_orderpriority, o_orderkey, row_number() OVER (ORDER BY turn, o_orderpriority) - 1 AS position FROM turns""")
def interleaved_files(spark, folder):
    return interleave(table(spark, folder, "orders").select("o_orderpriority", "o_orderkey"), "o_orderpriority", "o_orderkey")


@query(f"SELECT doc_id, lang FROM documents WHERE {_H.format(chr(39) + '3:' + chr(39) + ' || doc_id')} / 4294967296.0::DOUBLE < 0.8")
def sampled_fraction(spark, folder):
    return sample_fraction(table(spark, folder, "documents").select("doc_id", "lang"), 0.8, "doc_id", 3)


@query(f"""SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_H.format("'4:' || event_id")}, event_id) AS rn FROM events) WHERE rn <= 700""")
def sampled_per_class(spark, folder):
    return sample_n(table(spark, folder, "events").select("event_type", "event_id"), 700, "event_type", "event_id", 4)


@query(f"SELECT event_id, value FROM events WHERE {_H.format(chr(39) + '6:' + chr(39) + ' || event_id')} / 4294967296.0::DOUBLE <= 0.5")
def thinned_candidates(spark, folder):
    return thin_candidates(table(spark, folder, "events").select("event_id", "value"), 0.5, 6, "event_id")
