"""Near neighbours, Gram matrix and kernel components of the embeddings."""

import numpy as np
from pyspark.sql import functions as F

from tidewright.operators.blocks import centred_energy, gram, kernel_pca, residuals, row_means
from tidewright.operators.metrics import query_costs, vote_share
from tidewright.operators.similarity import LshIndex, bucket_numbers
from tidewright.plans.kernel_sweep import sigma_sweep
from tidewright.queries.fixtures import LABELS, RADIUS, planes, rounded, vectors, with_
from tidewright.queries.registry import query

C = 2.0
_NEAR = f"""candidates AS (SELECT DISTINCT q.vec_id AS query_id, i.vec_id AS img_id FROM buckets q JOIN buckets i ON q.table_id = i.table_id AND q.bucket = i.bucket),
    measured AS (SELECT query_id, img_id, b.label, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist
      FROM candidates c JOIN embeddings a ON query_id = a.vec_id JOIN embeddings b ON img_id = b.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, img_id) AS rank FROM measured WHERE dist <= {C * RADIUS}),
    near AS (SELECT * FROM ranked WHERE rank <= 10)"""


def _index(spark, folder):
    return LshIndex.build(vectors(spark, folder), "vec_id", None, "vec", planes=planes(), radius=RADIUS, label="label")


def _queries(spark, folder):
    return vectors(spark, folder).withColumnRenamed("vec_id", "query_id")


@query(with_("buckets", "SELECT vec_id, table_id, bucket FROM buckets"))
def hash_table_buckets(spark, folder):
    numbered = bucket_numbers(vectors(spark, folder).select("vec_id", "vec"), "vec", planes(), RADIUS)
    return numbered.select("vec_id", F.posexplode("buckets").alias("table_id", "bucket")).withColumn("table_id", F.col("table_id").cast("long"))


@query(with_("buckets", """SELECT q.vec_id AS query_id, count(DISTINCT i.vec_id) AS n_computed FROM buckets q JOIN buckets i
    ON q.table_id = i.table_id AND q.bucket = i.bucket GROUP BY 1"""))
def bucket_candidates(spark, folder):
    """How many vectors share a bucket with each query."""
    return _index(spark, folder).computed(_queries(spark, folder))


@query(with_("buckets", f""", {_NEAR} SELECT query_id, img_id, label, round(dist, 6) AS dist, CAST(rank AS INTEGER) AS rank FROM near"""))
def near_neighbours(spark, folder):
    return rounded(_index(spark, folder).query(_queries(spark, folder), 10, C).drop("patch"))


@query(with_("buckets", f""", {_NEAR}, sizes AS (SELECT query_id, count(*) AS k FROM near GROUP BY query_id)
    SELECT s.query_id, CAST(c.label AS INTEGER) AS class_name, round(count(n.label) / CAST(any_value(k) AS DOUBLE), 9) AS score FROM sizes s CROSS JOIN range(10) c(label)
    LEFT JOIN near n ON n.query_id = s.query_id AND n.label = c.label GROUP BY s.query_id, c.label"""))
def neighbour_votes(spark, folder):
    near = _index(spark, folder).query(_queries(spark, folder), 10, C)
    return rounded(vote_share(near, LABELS), 9)


@query(with_("buckets", f""", {_NEAR}, per AS (SELECT query_id, avg(dist) AS d FROM near GROUP BY query_id),
    work AS (SELECT query_id, count(*) AS n FROM candidates GROUP BY query_id)
    SELECT round(avg(d), 6) AS average_distance, round(avg(n), 6) AS average_compute FROM per JOIN work USING (query_id)"""))
def neighbour_costs(spark, folder):
    index, asked = _index(spark, folder), _queries(spark, folder)
    return rounded(query_costs(index.query(asked, 10, C), False, index.computed(asked)))


@query(with_("buckets", f""", {_NEAR}, ks AS (SELECT unnest([3, 5, 10]) AS kk), used AS (SELECT kk, near.* FROM near JOIN ks ON rank <= kk),
    sizes AS (SELECT kk, query_id, count(*) AS k FROM used GROUP BY ALL),
    votes AS (SELECT s.kk, s.query_id, c.label AS cls, count(n.label) / CAST(any_value(s.k) AS DOUBLE) AS score FROM sizes s CROSS JOIN range(10) c(label)
      LEFT JOIN used n ON n.kk = s.kk AND n.query_id = s.query_id AND n.label = c.label GROUP BY ALL),
    judged AS (SELECT kk, cls, round(score, 9) AS score, CAST(e.label = cls AS INTEGER) AS y FROM votes v JOIN embeddings e ON v.query_id = e.vec_id),
    levels AS (SELECT kk, cls, score, sum(y) AS pos, count(*) AS n FROM judged GROUP BY ALL),
    cum AS (SELECT kk, cls, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM levels WINDOW w AS (PARTITION BY kk, cls ORDER BY score DESC)),
    aps AS (SELECT kk, cls, sum(pos * (CAST(tp AS DOUBLE) / seen)) / sum(pos) AS ap FROM cum GROUP BY ALL HAVING sum(pos) > 0),
    costs AS (SELECT kk, avg(d) AS ad FROM (SELECT kk, query_id, avg(dist) AS d FROM used GROUP BY ALL) GROUP BY kk),
    work AS (SELECT s.kk, avg(n) AS an FROM (SELECT DISTINCT kk, query_id FROM used) s JOIN (SELECT query_id, count(*) AS n FROM candidates GROUP BY 1) w USING (query_id) GROUP BY s.kk)
    SELECT CAST(kk AS INTEGER) AS k, round(map, 6) AS map, round(ad, 6) AS average_distance, round(an, 6) AS average_compute
    FROM (SELECT kk, avg(ap) AS map FROM aps WHERE cls <> 9 GROUP BY kk) JOIN costs USING (kk) JOIN work USING (kk)"""))
def neighbour_evaluation(spark, folder):
    """mAP (label 9 taken as background), mean distance and mean work for three k."""
    return rounded(_index(spark, folder).evaluate(_queries(spark, folder), LABELS, [3, 5, 10], C, background=9))


@query("""WITH cells AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
    SELECT CAST(a.i - 1 AS INTEGER) AS i, CAST(b.i - 1 AS INTEGER) AS j, round(sum(CAST(a.v AS DOUBLE) * CAST(b.v AS DOUBLE)) / 64.0, 6) AS g
    FROM cells a JOIN cells b USING (vec_id) GROUP BY ALL""")
def gram_matrix(spark, folder):
    return rounded(gram(vectors(spark, folder), "vec", 64.0))


_D2 = """d AS (SELECT a.vec_id AS i, b.vec_id AS j, pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2) AS d2 FROM embeddings a, embeddings b)"""


@query(f"WITH {_D2} SELECT i AS id, round(avg(d2), 6) AS row_mean FROM d GROUP BY i")
def distance_row_means(spark, folder):
    """Mean of each row of the distance matrix."""
    return rounded(row_means(vectors(spark, folder), "vec_id", "vec", block=128))


@query(f"WITH {_D2} SELECT i AS id, round(avg(exp(-d2 / 0.64)), 6) AS row_mean FROM d GROUP BY i")
def kernel_row_means(spark, folder):
    return rounded(row_means(vectors(spark, folder), "vec_id", "vec", 0.8, 128))


@query(f"""WITH {_D2}, k AS (SELECT i, j, exp(-d2 / 0.64) AS k FROM d), m AS (SELECT i, avg(k) AS m FROM k GROUP BY i), g AS (SELECT avg(k) AS g FROM k),
    c AS (SELECT k.i, k.k - a.m - b.m + g AS c FROM k JOIN m a ON k.i = a.i JOIN m b ON k.j = b.i, g)
    SELECT i AS id, round(sum(c * c), 5) AS energy FROM c GROUP BY i""")
def centred_kernel_energy(spark, folder):
    """Sum of squares of each row of the centred kernel."""
    return rounded(centred_energy(vectors(spark, folder), "vec_id", "vec", 0.8, 128), 5)


_COMPONENTS: dict = {}


def _components(spark, folder, anew: bool = False):
    """Values and components of one width, found once a session; the frame reads a stored table."""
    key = (spark.sparkContext.applicationId, folder)
    if anew or key not in _COMPONENTS:
        _COMPONENTS[key] = kernel_pca(vectors(spark, folder), "vec_id", "vec", [0.8], 3, block=128)[0]
    return _COMPONENTS[key]


@query()
def kernel_components(spark, folder):
    return _components(spark, folder, anew=True)[1]


@query("SELECT CAST(unnest(range(3)) AS INTEGER) AS k, 1.0::DOUBLE AS length, 0.0::DOUBLE AS mean, true AS settled")
def kernel_residuals(spark, folder):
    """Components are of length 1, centred, and eigenvectors to 1e-3 by one more product with the kernel."""
    values, components = _components(spark, folder)
    found = residuals(vectors(spark, folder), "vec_id", "vec", 0.8, values, components, 128)
    return rounded(found.select("k", "length", F.abs("mean").alias("mean"), (F.col("residual") <= 1e-3).alias("settled")))


@query()
def error_by_width(spark, folder):
    return sigma_sweep(vectors(spark, folder), "vec_id", "vec", "label", [1, 3], [0.8, 1.6])
