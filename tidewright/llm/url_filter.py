"""URL verdicts: host rules first, boosted trees on lexical features for the rest.

The labelled URLs are those that a rule decides. A bounded sample of them
(``fit_rows``) trains gradient-boosted trees on length, depth, digit ratio,
character entropy, parameter counts and smoothed block rates of host suffixes,
domains and first path parts; the rates count all labelled URLs.
Everything is built of column functions and the JVM's tree learner; rules are a
literal, so no join is made for them, and suffix statistics are joined on the
suffix after aggregation, whose size is that of the distinct suffixes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import store

#: Rules of the query: host, path, verdict. Fixed values.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Most labelled rows the trees are fitted on, chosen by hash.
FIT_ROWS = 20_000
#: Rows by which a suffix's block rate is drawn to the overall rate.
PRIOR_ROWS = 20.0
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "mark_ratio", "entropy",
    "parameters", "has_fragment", "is_https", "suffix_rate", "domain_rate", "first_part_rate",
]


@dataclass(frozen=True)
class UrlModel:
    trees: object
    rates: dict[str, DataFrame]
    prior: float


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for null or without ``://``."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null.

    Longest counts the characters of host and path together; of equals the longer host, then the order of the list.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in reversed(ranked):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _share(text: Column, characters: str) -> Column:
    """Share of characters of a class."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, characters, ""))) / n).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits.

    The sorted characters are cut into runs of equal ones; a run's length is what the sum needs.
    """
    runs = F.regexp_extract_all(F.array_join(F.array_sort(F.split(text, "")), ""), F.lit(r"(?s)((.)\2*)"), F.lit(1))
    n = F.length(text)
    return F.when(n > 0, F.aggregate(runs, F.lit(0.0), lambda h, r: h - (F.length(r) / n) * F.log2(F.length(r) / n))).otherwise(0.0)


def lexical_features(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """All rows and columns with host, path and lexical features under names that start with an underscore."""
    host, path = split_url(url_col)
    url = F.coalesce(F.col(url_col), F.lit(""))
    out = pages.withColumn("_host", host).withColumn("_path", path)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split("_host", r"\.")
    return out.select(
        "*",
        F.length(url).cast("double").alias("_url_length"), F.length("_host").cast("double").alias("_host_length"),
        F.length("_path").cast("double").alias("_path_length"),
        F.size(F.filter(F.split("_path", "/"), lambda p: p != "")).cast("double").alias("_depth"),
        F.size(labels).cast("double").alias("_labels"),
        _share(url, "[0-9]").alias("_digit_ratio"), _share(F.col("_host"), "[0-9]").alias("_host_digit_ratio"),
        _share(url, "[A-Za-z0-9]").alias("_mark_ratio"), _entropy(url).alias("_entropy"),
        F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double").alias("_parameters"),
        F.contains(url, F.lit("#")).cast("double").alias("_has_fragment"),
        F.startswith(url, F.lit("https:")).cast("double").alias("_is_https"),
        *_keys(),
    )


def _sample(distinct: DataFrame, n: int, rows: int) -> DataFrame:
    """At most about ``rows`` of ``n`` rows by hash of the URL."""
    return distinct if n <= rows else distinct.where(F.pmod(F.xxhash64("_url"), F.lit(1 << 20)) < int((1 << 20) * rows / n))


def _keys() -> list[Column]:
    """Host suffix, domain and first part of the path, over which block rates are counted."""
    return [
        F.substring_index("_host", ".", -1).alias("_suffix"), F.substring_index("_host", ".", -2).alias("_domain"),
        F.regexp_extract("_path", r"^/([^/]*)", 1).alias("_first_part"),
    ]


def _rates(labelled: DataFrame, key: str, prior: float) -> DataFrame:
    rate = (F.sum("_label") + PRIOR_ROWS * prior) / (F.count("*") + PRIOR_ROWS)
    return labelled.groupBy(key).agg(rate.alias(f"{key}_rate"))


def _with_rates(rows: DataFrame, rates: dict[str, DataFrame], prior: float) -> DataFrame:
    for key, table in rates.items():
        rows = rows.join(table, key, "left").withColumn(f"{key}_rate", F.coalesce(f"{key}_rate", F.lit(prior)))
    return rows


def fit(pages: DataFrame, rules=RULES, url_col: str = "url", fit_rows: int = FIT_ROWS, rounds: int = 15, depth: int = 4) -> UrlModel | None:
    """Trees from the URLs that a rule decides; None where they hold one verdict only.

    ``fit_rows`` bounds the labelled rows for the trees; the block rates count all labelled URLs, equal ones once. Nulls are
    never labelled.
    """
    name, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    host, path = split_url(url_col)
    labelled = (
        pages.select(F.col(url_col).alias("_url"), host.alias("_host"), path.alias("_path"))
        .select("_url", (verdict == "block").cast("double").alias("_label"), *_keys())
        .where(F.col("_label").isNotNull())
    )
    labelled = store(labelled.dropDuplicates(["_url"]), "labelled_urls")
    prior, least, most, n = labelled.agg(F.avg("_label"), F.min("_label"), F.max("_label"), F.count("*")).first()
    if least == most:  # also without rows
        return None
    rates = {key: store(_rates(labelled, key, prior), f"rates{key}") for key in ("_suffix", "_domain", "_first_part")}
    sample = lexical_features(_sample(labelled.select("_url", "_label"), n, fit_rows), "_url").cache()
    train = _assemble(_with_rates(sample, rates, prior))
    trees = GBTClassifier(
        labelCol="_label", featuresCol="_features", maxIter=rounds, maxDepth=depth, seed=7, stepSize=0.2, cacheNodeIds=False,
    ).fit(train)
    return UrlModel(trees, rates, prior)


def _assemble(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_{f}" for f in FEATURES], outputCol="_features", handleInvalid="keep").transform(rows)


def judge(pages: DataFrame, model: UrlModel | None, rules=RULES, url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """All rows and columns with host, path, rule, block_score and verdict.

    A rule decides where one fits; ``block_score`` of the trees decides the rest (allow without a model). Null and
    malformed URLs have empty host and path, no rule, and are scored like any other. Columns of the new names are replaced.
    """
    base = pages.drop("host", "path", "rule", "block_score", "verdict")
    rows = lexical_features(base, url_col)
    name, says = rule_of(F.col("_host"), F.col("_path"), rules)
    if model is None:
        scored = rows.withColumn("block_score", F.lit(0.0))
    else:
        features = _assemble(_with_rates(rows, model.rates, model.prior))
        scored = model.trees.transform(features).withColumn("block_score", vector_to_array("probability")[1])
    return scored.select(
        *[F.col(c) for c in base.columns], F.col("_host").alias("host"), F.col("_path").alias("path"), name.alias("rule"), "block_score",
        F.coalesce(says, F.when(F.col("block_score") >= threshold, "block").otherwise("allow")).alias("verdict"),
    )
