"""Pipeline over ``documents``: stages in order, each written as Parquet and read again as the next one's input.

1. Language: documents without a recognisable language go.
2. N-gram Jaccard join: of each group of near copies the document with the smallest id stays.
3. Benchmark decontamination: spans of benchmark windows are cut out, documents made of them go.
4. Secrets are replaced by a mark.
5. Byte-level BPE: ids of each text and the text that they decode to.

The first four return the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import bpe, decontaminate, jaccard, language, secret_scan
from tidewright.llm.common import store, table
from tidewright.session import ship_package


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the number of characters of the text at hand."""
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return docs.select(*columns)


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    model = language.fit(docs, F.lit(True))
    found = language.identify(docs, model)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    marked = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return _recounted(decontaminate.remove_spans(marked), docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return _recounted(secret_scan.redact(secret_scan.scan(docs)), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    both = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select(
        *[c for c in docs.columns if c != "text"], F.decode("decoded", "UTF-8").alias("text"), "ids", F.size("ids").cast("long").alias("n_tokens"),
    )


STAGES = [
    ("language", known_language), ("near_copies", one_of_near_copies), ("benchmark", without_benchmark), ("secrets", without_secrets),
    ("tokens", tokens),
]
#: Learned models and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, folder), f"stage-{name}")
    return docs
