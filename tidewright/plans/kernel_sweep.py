"""Error of a softmax fit on kernel components, over numbers of components and widths."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.blocks import BLOCK, kernel_pca
from tidewright.operators.metrics import best_by
from tidewright.session import cut


def sigma_sweep(df: DataFrame, id: str, vec: str, label: str, ds, sigmas, tol: float = 1e-3, block: int = BLOCK, softmax_iter: int = 100) -> DataFrame:
    """Training error for each (d, sigma).

    The components of all widths are found together, for the largest d: leading
    components are the same for every d, so smaller ones are their first columns.
    """
    rows = []
    labels = df.select(F.col(id).alias("id"), F.col(label).cast("double").alias("y"))
    for sigma, (_, components) in zip(sigmas, kernel_pca(df, id, vec, list(sigmas), max(ds), tol, block=block)):
        table = cut(components.join(labels, "id"))
        for d in ds:
            data = table.withColumn("x", array_to_vector(F.slice("component", 1, d)))
            softmax = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=0.0, maxIter=softmax_iter)
            wrong = softmax.fit(data).transform(data).agg(F.avg((F.col("prediction") != F.col("y")).cast("double")))
            rows.append((int(d), float(sigma), float(wrong.first()[0])))
    return df.sparkSession.createDataFrame(rows, "d int, sigma double, err double")


def best_widths(sweep: DataFrame) -> DataFrame:
    """Least error over the widths for each d."""
    return best_by(sweep, "d", "err", "best_err")
