"""Token-id files whose document boundaries are Elias-Fano coded.

A file set is a Parquet table of *blocks*. Each block holds the ids of some
consecutive documents as one little-endian array and the start of each document
in it as an Elias-Fano sequence: about ``2 + log2(ids / documents)`` bits per
document where a table of offsets takes 64. ``select`` samples let a reader jump
to document i of a block without decoding the ones before it. The place of a
block among all ids is the sum of the partitions before it (one number per
partition) and the running sum inside its partition.

Documents are written in ascending id order: a range exchange and a sort inside
each partition, no single task. Ties of the id are ordered by text hash, so
one id with very many rows is spread over partitions.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.common import WORD_AND_MARKS, Remembered, claim, empty_if_null, slices, text_bytes

#: A block is closed at this many ids; one longer document makes one longer block.
BLOCK_IDS = 1 << 20
#: One select sample for so many documents.
SAMPLE = 64
#: Words of a generation of a worker's memory.
CACHE_WORDS = 600_000


def _byte_letters() -> dict[int, str]:
    """For each non-ASCII letter of WORD_AND_MARKS the characters that byte-level vocabularies write for its UTF-8 bytes.

    Printable bytes stand for themselves, the others for 256, 257, ... in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


BYTE_LETTERS = _byte_letters()

BLOCKS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_id", pa.list_(pa.int64())),
    ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary()),
])
BLOCKS_DDL = (
    "part int, block int, first long, n_ids long, doc_id array<long>, ids binary, low_bits int, low binary, high binary, samples binary"
)


def ef_encode(values: np.ndarray, bound: int) -> tuple[int, bytes, bytes, bytes]:
    """Low width, low bits, high bits and select samples of ascending numbers below or equal ``bound``."""
    n = len(values)
    width = max(0, int(bound // max(n, 1)).bit_length() - 1)
    values = values.astype(np.int64)
    low = (values[:, None] >> np.arange(width)) & 1
    places = (values >> width) + np.arange(n)
    high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    high[places] = 1
    packed = np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return width, packed, np.packbits(high, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes()


def ef_decode(n: int, width: int, low: bytes, high: bytes) -> np.ndarray:
    """All values at once."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little"))[:n]
    bits = np.unpackbits(np.frombuffer(low, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return ((ones - np.arange(n)) << width) | (bits.astype(np.int64) << np.arange(width)).sum(1)


def ef_select(i: int, width: int, low: bytes, high: bytes, samples: bytes) -> int:
    """The i-th value: jump to the nearest sample, then count ones byte by byte."""
    place = int(np.frombuffer(samples, "<u4")[i // SAMPLE])
    left = i % SAMPLE
    at, seen = place // 8, high[place // 8] >> (place % 8)
    shift = place % 8
    while seen.bit_count() <= left:
        left -= seen.bit_count()
        at, shift = at + 1, 0
        seen = high[at]
    while True:
        if seen & 1:
            if not left:
                break
            left -= 1
        seen >>= 1
        shift += 1
    value = (at * 8 + shift - i) << width
    for b in range(width):
        bit = i * width + b
        value |= (low[bit // 8] >> (bit % 8) & 1) << b
    return value


class WordIds(Remembered):
    """Ids of blank-free words as bytes, filled by the tokenizer on first sight.

    The vocabulary's pre-tokenizer drops white space and no token spans it, so a
    text's ids are those of its blank-separated words one after another, and
    marks after letters are tokens of their own. ASCII case does not matter, as
    the normalizer lowers it, so callers may pass lowered bytes.
    """

    def __init__(self, path: str, dtype: str):
        super().__init__(self._ids, CACHE_WORDS)
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # for words of texts without an added token
        self.whole = Tokenizer.from_file(path)
        self.added = [t.content.lower().encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.dtype = np.dtype(dtype)

    def of_text(self, text: bytes) -> bytes:
        """Ids of a whole text. One that holds an added token goes through the library as it is."""
        low = text.lower()
        if any(t in low for t in self.added):
            return self._pack(self.whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, low.split()))

    def _ids(self, word: bytes) -> bytes:
        if word.isalpha():  # of bytes: ASCII letters only
            return self._letters(word.decode())
        text = word.decode("utf-8", "replace")
        parts = WORD_AND_MARKS.fullmatch(text)
        if parts is None:
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if parts[2]:
            return self[parts[1].encode()] + self[parts[2].encode()]
        return self._letters(text)

    def _letters(self, text: str) -> bytes:
        """Composed letters: of the normalizer's work only case and bytes remain."""
        shown = text.lower() if text.isascii() else text.lower().translate(BYTE_LETTERS)
        return self._pack([t.id for t in self.tokenizer.model.tokenize(shown)])

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.dtype.char, ids).tobytes()


_TOKENIZERS: dict[tuple[str, str], WordIds] = {}


def _word_ids(path: str, dtype: str) -> WordIds:
    claim("token_file", _TOKENIZERS.clear)
    if (path, dtype) not in _TOKENIZERS:
        _TOKENIZERS[path, dtype] = WordIds(path, dtype)
    return _TOKENIZERS[path, dtype]


def _block(part: int, number: int, first: int, ids: list[int | None], payloads: list[bytes], width: int) -> pa.RecordBatch:
    sizes = np.fromiter((len(p) // width for p in payloads), np.int64, len(payloads))
    starts = np.cumsum(sizes) - sizes
    low_bits, low, high, samples = ef_encode(starts, int(sizes.sum()))
    row = [part, number, first, int(sizes.sum()), ids, b"".join(payloads), low_bits, low, high, samples]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)


def write_token_file(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int = 49_408, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts and write them in ascending order of ``id_col``.

    Null or empty text is the end id alone; a null id comes first; repeated rows
    are kept, tied ids follow their text hash; an empty table writes no block.
    Other columns are ignored. Ids take two bytes where the vocabulary allows it.
    """
    dtype = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    width = int(dtype[-1])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer, dtype)
        end = np.asarray([end_id], dtype).tobytes()
        part, number, first = TaskContext.get().partitionId(), 0, 0
        ids, payloads, size = [], [], 0
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                payload = words.of_text(text) + end
                if ids and size + len(payload) > block_ids * width:
                    yield _block(part, number, first, ids, payloads, width)
                    number, first = number + 1, first + size // width
                    ids, payloads, size = [], [], 0
                ids.append(doc)
                payloads.append(payload)
                size += len(payload)
        if ids:
            yield _block(part, number, first, ids, payloads, width)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    ordered = (
        rows.withColumn("_hash", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_hash")
        .sortWithinPartitions("doc_id", "_hash")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(encode, BLOCKS_DDL).write.parquet(path)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each partition; one row per partition, so one task adds them up."""
    sizes = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def read_token_file(spark: SparkSession, path: str, vocabulary: int = 49_408) -> DataFrame:
    """One row per document: doc_id, start among all ids, n_tokens, ids as little-endian 32-bit numbers."""
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs, ids = row["doc_id"], np.frombuffer(row["ids"], dtype).astype("<u4")
                starts = ef_decode(len(docs), row["low_bits"], row["low"], row["high"])
                ends = np.append(starts[1:], len(ids))
                raw = ids.tobytes()
                parts = [raw[4 * a: 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [docs, starts + row["_before"] + row["first"], ends - starts, parts]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    blocks = spark.read.parquet(path).select("part", "first", "doc_id", "ids", "low_bits", "low", "high")
    placed = blocks.join(F.broadcast(block_starts(spark, path)), "part")  # one row per partition of the writer
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def fetch_document(block: dict, i: int, dtype: str = "<u2") -> np.ndarray:
    """Ids of document i of one block by select, without decoding the other boundaries."""
    args = block["low_bits"], bytes(block["low"]), bytes(block["high"]), bytes(block["samples"])
    start = ef_select(i, *args)
    end = ef_select(i + 1, *args) if i + 1 < len(block["doc_id"]) else block["n_ids"]
    return np.frombuffer(block["ids"], dtype)[start:end]
