"""Fit-and-apply features for tabular data.

A fitted object holds only column statistics, so training and test data get the
same columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.keys import match_on

def kinetic(df: DataFrame, cols, name: str = "kinetic") -> DataFrame:
    """Sum of squared shares of the distinct values within one row; null is a value of its own."""
    n = len(cols)
    values = [F.col(c) for c in cols]
    # Equal pairs count each value n_v * (n_v - 1) / 2 times: the sum of squares without arrays.
    pairs = [values[i].eqNullSafe(values[j]).cast("int") for i in range(n) for j in range(i)]
    return df.withColumn(name, (F.lit(n) + 2 * sum(pairs, F.lit(0))) / F.lit(float(n * n)))


def kinetic_groups(df: DataFrame, compat: bool = False) -> DataFrame:
    """The four row scores of the policy data, by column name.

    The published third score reads the columns of the second group;
    ``compat`` gives that value, the default the evident intention.
    """
    named = {
        "kinetic_1": [c for c in df.columns if "_ind_" in c],
        "kinetic_2": [c for c in df.columns if "_car_" in c and c.endswith("cat")],
        "kinetic_3": [c for c in df.columns if "_calc_" in c and not c.endswith("bin")],
        "kinetic_4": [c for c in df.columns if "_calc_" in c and c.endswith("bin")],
    }
    if compat:
        named["kinetic_3"] = named["kinetic_2"]
    out = df
    for name, cols in named.items():
        out = kinetic(out, cols, name) if cols else out.withColumn(name, F.lit(None).cast("double"))
    return out


@dataclass(frozen=True)
class Scaler:
    """Zero mean and unit population deviation; a constant column is only centred."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols) -> Scaler:
        row = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols],
        ).first()
        return cls({c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()}
        )


def _fitted_values(df: DataFrame, col: str) -> list:
    """Sorted distinct values. Each becomes a column, so they fit in a plan; for other columns there is ``WideOneHot``."""
    return [r[0] for r in df.select(col).distinct().filter(F.col(col).isNotNull()).orderBy(col).collect()]


@dataclass(frozen=True)
class OneHot:
    """One 0/1 column for each value seen at fit time; null and unseen values give all 0."""

    values: dict[str, list]

    @classmethod
    def fit(cls, df: DataFrame, cols) -> OneHot:
        return cls({c: _fitted_values(df, c) for c in cols})

    def names(self, col: str) -> list[str]:
        return [f"{col}_{v}" for v in self.values[col]]

    def transform(self, df: DataFrame) -> DataFrame:
        added = {
            name: F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
            for c in self.values
            for name, v in zip(self.names(c), self.values[c])
        }
        return df.select(*[c for c in df.columns if c not in self.values], *[e.alias(n) for n, e in added.items()])


@dataclass(frozen=True)
class LabelBinarizer:
    """As one-hot, but two values give one column (1 for the greater value), one value a 0 column."""

    values: dict[str, list]

    @classmethod
    def fit(cls, df: DataFrame, cols) -> LabelBinarizer:
        return cls({c: _fitted_values(df, c) for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        out = [F.col(c) for c in df.columns if c not in self.values]
        for c, values in self.values.items():
            hot = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for v in values]
            if len(values) == 1:
                out.append(F.lit(0).alias(c))
            elif len(values) == 2:
                out.append(hot[1].alias(c))
            else:
                out += [h.alias(f"{c}_{v}") for h, v in zip(hot, values)]
        return df.select(*out)


class WideOneHot:
    """Sparse one-hot vectors for columns with very many values."""

    def __init__(self, indexer, encoder, cols):
        self._indexer, self._encoder, self._cols = indexer, encoder, cols

    @classmethod
    def fit(cls, df: DataFrame, cols) -> WideOneHot:
        index = [f"{c}_index" for c in cols]
        indexer = StringIndexer(
            inputCols=cols, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"
        ).fit(df)
        encoder = OneHotEncoder(
            inputCols=index, outputCols=[f"{c}_vec" for c in cols], dropLast=True, handleInvalid="keep"
        ).fit(indexer.transform(df))
        return cls(indexer, encoder, cols)

    def transform(self, df: DataFrame) -> DataFrame:
        out = self._encoder.transform(self._indexer.transform(df))
        return out.drop(*[f"{c}_index" for c in self._cols])


@dataclass(frozen=True)
class FeatureTable:
    """Scale numeric, binarise categorical and keep binary columns, by column name."""

    scaler: Scaler
    binarizer: LabelBinarizer

    @classmethod
    def fit(cls, df: DataFrame, roles: dict[str, list[str]]) -> FeatureTable:
        return cls(Scaler.fit(df, roles["numeric"]), LabelBinarizer.fit(df, roles["categorical"]))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.binarizer.transform(self.scaler.transform(df))


def quantile_bins(df: DataFrame, cols, bins: int, error: float = 0.001) -> DataFrame:
    """Replace numeric columns by the number of their quantile bin."""
    limits = df.approxQuantile(list(cols), [i / bins for i in range(1, bins)], error)
    out = df
    for c, cuts in zip(cols, limits):
        splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
        if len(splits) < 3:
            out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.lit(0.0)))
            continue
        cast = out.withColumn(c, F.col(c).cast("double"))
        binned = Bucketizer(splits=splits, inputCol=c, outputCol="_bin", handleInvalid="keep").transform(cast)
        out = binned.withColumn(c, F.col("_bin")).drop("_bin")
    return out


def mutual_information(df: DataFrame, cols, label: str, bins: int | None = None) -> DataFrame:
    """Mutual information of each column with the label, in nats, from value counts.

    With ``bins`` the columns are cut at their quantiles first. All columns go
    through one unpivot and one aggregation.
    """
    cols = list(cols)
    source = quantile_bins(df, cols, bins) if bins else df
    pairs = source.select(
        F.col(label).alias("y"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols
        ])).alias("p"),
    ).select("y", "p.feature", "p.v")
    joint = pairs.groupBy("feature", "v", "y").agg(F.count(F.lit(1)).alias("n_vy"))
    by_value = joint.groupBy("feature", "v").agg(F.sum("n_vy").alias("n_v"))
    by_label = joint.groupBy("feature", "y").agg(F.sum("n_vy").alias("n_y"))
    totals = joint.groupBy("feature").agg(F.sum("n_vy").alias("n"))
    full = match_on(match_on(match_on(joint, by_value, ["feature", "v"]), by_label, ["feature", "y"]), totals, ["feature"])
    term = F.col("n_vy") / F.col("n") * F.log(F.col("n_vy") * F.col("n") / (F.col("n_v") * F.col("n_y")))
    return full.groupBy("feature").agg(F.sum(term).alias("mi"))


def assemble(df: DataFrame, cols, name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name).transform(df)
