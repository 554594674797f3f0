"""Language of texts by multilingual mixture inference.

Each language has a distribution of byte n-grams, learned from a bounded sample of
labelled rows. A document is seen as a mixture: expectation-maximisation estimates
which share of its n-grams each language accounts for. The set of languages is
chosen by penalised likelihood: the strongest ones are added as long as the gain in
log likelihood exceeds half a log n for each further share. The prediction is the language with
the largest share.

N-grams are hashed into a fixed number of buckets, so the model, which is broadcast, has a fixed
size per language; fitting sums bucket counts per language on the executors. Prediction is per row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.keys import hash_unit
from tidewright.llm.common import claim, slices, text_bytes

#: Labelled rows per language that the model is fitted on, about; chosen by hash of id and text.
FIT_ROWS = 2_000
#: Buckets of n-grams, as a power of two.
BUCKET_BITS = 15
#: Added to each bucket's count.
SMOOTHING = 0.5
#: Rounds of expectation-maximisation and most languages of one text.
ROUNDS, MOST_LANGUAGES = 6, 4
UNKNOWN = "und"

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text: A-Z lowered, runs of what is no letter one blank."""
    plain = b" ".join(text.translate(_LETTERS).split())
    raw = np.frombuffer(b" " + plain + b" ", np.uint8).astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def has_letter(text: bytes) -> bool:
    lowered = text.translate(_LETTERS)
    if not lowered.isascii():
        return any(map(str.isalpha, text.decode("utf-8", "replace")))
    return not lowered.isspace() and bool(lowered)


@dataclass(frozen=True)
class LanguageModel:
    """Languages and the probability of each bucket: one row per bucket, one column per language."""

    names: list[str]
    table: np.ndarray

    def shares(self, text: bytes) -> tuple[list[int], np.ndarray]:
        """Chosen languages and their shares."""
        codes = grams(text)
        buckets, counts = codes, None
        if len(codes) > 1 << BUCKET_BITS:
            counts = np.bincount(codes, minlength=1 << BUCKET_BITS)
            buckets = np.flatnonzero(counts)
            counts = counts[buckets].astype(np.float32)
        p, n = self.table[buckets], len(codes)
        weights, _ = _mixture(p, counts, n)
        order = np.argsort(-weights, kind="stable")
        best = None
        for k in range(1, min(MOST_LANGUAGES, len(order)) + 1):
            chosen = order[:k]
            found, likelihood = _mixture(p[:, chosen], counts, n)
            score = likelihood - 0.5 * (k - 1) * np.log(n)
            if best is not None and score <= best[0]:
                break
            best = score, chosen.tolist(), found
        return best[1], best[2]

    def predict(self, text: bytes) -> tuple[str, float]:
        """Language and its share; unknown without letters or without a learned language."""
        if not self.names or not has_letter(text):
            return UNKNOWN, 0.0
        chosen, weights = self.shares(text)
        top = int(np.argmax(weights))
        return self.names[chosen[top]], float(min(1.0, max(0.0, weights[top])))


def _mixture(p: np.ndarray, counts: np.ndarray | None, n: int) -> tuple[np.ndarray, float]:
    """Shares of the columns of p and the log likelihood."""
    k = p.shape[1]
    weights = np.full(k, 1 / k, np.float32)
    for _ in range(ROUNDS if k > 1 else 0):
        ratio = 1 / (p @ weights)
        if counts is not None:
            ratio *= counts
        weights = weights * (ratio @ p) / n
        weights /= weights.sum()
    logs = np.log(p @ weights)
    return weights, float(logs.sum(dtype=np.float64) if counts is None else np.dot(counts.astype(np.float64), logs))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 modulo 3. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(
    docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", fit_rows: int = FIT_ROWS,
) -> LanguageModel:
    """Bucket probabilities from rows with ``learn`` that have text and language.

    ``fit_rows`` bounds the rows per language in expectation: a row is taken when its hash is below fit_rows / rows of the language.
    """
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.groupBy(F.col(lang_col).alias("_lang")).agg(F.count("*").alias("_n"))
    rows = labelled.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"), F.col(id_col).cast("string").alias("_id"))
    draw = hash_unit("language", F.coalesce("_id", F.lit("")), F.xxhash64("_text"))
    sample = rows.join(F.broadcast(counts), "_lang").where(draw * F.col("_n") < fit_rows)  # one row per language, as in the model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language", int)  # nothing to forget
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                if has_letter(text):
                    found = np.bincount(grams(text), minlength=1 << BUCKET_BITS)
                    sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            used = np.flatnonzero(found)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(found[used], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    sums = sample.select("_lang", "_text").mapInArrow(count, "lang string, bucket int, n long")
    found = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most 2**15 rows per language
    names = sorted(found["lang"].unique())
    table = np.full((1 << BUCKET_BITS, len(names)), SMOOTHING)
    for i, name in enumerate(names):
        mine = found[found["lang"] == name]
        table[mine["bucket"].to_numpy(), i] += mine["n"].to_numpy()
    return LanguageModel(names, (table / table.sum(0)).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``score``, the share of that language.

    Null texts and texts without a letter are ``und`` with score 0, as is each text where nothing was learned. Equal texts get
    equal answers; columns of the new names are replaced.
    """
    out = docs.drop("lang_pred", "score")
    columns = out.columns
    schema = out.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language", int)
        local = LanguageModel(*shared.value)
        for batch in slices(batches):
            found = [local.predict(t) for t in text_bytes(batch.column(text_col))]
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], names=[*columns, "lang_pred", "score"])

    return out.mapInArrow(run, schema)
