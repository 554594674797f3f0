"""Byte-level BPE by monoid tree reduction.

A text is cut into pieces by the vocabulary's pattern and each piece is encoded
as a reduction over a balanced tree: both halves are encoded, then joined. A token
sequence is what BPE yields exactly when each two neighbours, encoded together,
come out as these two again (shown for rank-ordered merges in published work on
linear-time BPE). So a join looks at the tokens on both sides of the seam only: it
encodes a window of them anew and widens it until the pairs at its two edges are stable in
this sense; what lies outside cannot change. Joins of the same sequences are
remembered, so a word made of known halves costs a few look-ups. Decoding
concatenates the tokens' bytes, which is the same tree with concatenation as its
join.

All work is per row and no group is gathered; memory is one text plus caches of
bounded size.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import WORD_AND_MARKS, Remembered, claim, slices, text_bytes

#: Entries of a generation of the cache of chunks and of each other cache: at most some 100 MB in all.
CACHE_CHUNKS, CACHE = 160_000, 40_000
#: Longest piece or half that is remembered, in bytes.
REMEMBERED = 48
#: Bytes of a leaf of the tree, which is merged directly.
LEAF = 6
NO_RANK = 1 << 60


class Ranks:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self._merged = Remembered(self._merge_short, CACHE)
        self._stable = Remembered(self._is_stable, CACHE)
        self.chunks = _Chunks(self)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merge the lowest rank first, leftmost of equals; the leaves of the tree and its windows."""
        return self._merged[piece] if len(piece) <= REMEMBERED else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        get = self.ranks.get
        parts = [piece[i: i + 1] for i in range(len(piece))]
        pairs = [get(piece[i: i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == NO_RANK:
                break
            at = pairs.index(best)
            parts[at] += parts.pop(at + 1)
            pairs.pop(at)
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], NO_RANK)
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], NO_RANK)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap of pairs, for windows of any length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # part i covers piece[i:end[i]]; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i: i + 2])) is not None]
        heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n and (r := ranks.get(piece[i: end[end[i]]])) is not None:
                heappush(heap, (r, i, end[end[i]]))

        while heap:
            _, i, stop = heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != stop:
                continue
            end[end[i]], end[i] = 0, stop
            if stop < n:
                before[stop] = i
            offer(i)
            offer(before[i])
        return tuple([ranks[piece[i:e]] for i, e in enumerate(end) if e])

    def _is_stable(self, pair: tuple[int, int]) -> bool:
        """Whether two neighbours, encoded together, stay these two."""
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == pair

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of the concatenation of two encoded strings."""
        if not left or not right or self._stable[left[-1], right[0]]:
            return left + right
        i, j = len(left) - 1, 1
        while True:
            window = self.merge(b"".join([self.bytes_of[t] for t in (*left[i:], *right[:j])]))
            open_left = i > 0 and not self._stable[left[i - 1], window[0]]
            open_right = j < len(right) and not self._stable[window[-1], right[j]]
            if not open_left and not open_right:
                return left[:i] + window + right[j:]
            grow = max(1, (len(left) - i + j) // 2)
            i = max(0, i - grow) if open_left else i
            j = min(len(right), j + grow) if open_right else j

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        if rank is not None:
            return (rank,)
        if len(piece) <= LEAF:
            return self.merge(piece)
        return self._reduce(piece)

    def _reduce(self, piece: bytes) -> tuple[int, ...]:
        half = 1 << (len(piece) - 1).bit_length() - 1  # halves that start alike are met again
        return self.join(self.encode_piece(piece[:half]), self.encode_piece(piece[half:]))

    def encode(self, text: str) -> tuple[int, ...]:
        """Ids of a text: pieces do not merge with each other, so their join is concatenation."""
        return tuple([i for piece in self.pieces(text) for i in self.encode_piece(piece.encode())])

    def encode_bytes(self, raw: bytes) -> bytes:
        """Ids of a text given and returned as bytes (int32).

        Texts are cut at single blanks first; see ``_Chunks``. Where that is not allowed, the pattern runs over the text.
        """
        if not raw:
            return b""
        first, *rest = raw.split(b" ")
        try:
            chunks = self.chunks
            return b"".join([chunks.ids(first, b""), *map(chunks.__getitem__, rest)])
        except TypeError:
            return array("i", self.encode(raw.decode())).tobytes()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Chunks(Remembered):
    """Ids (int32 bytes) of a blank and what follows up to the next blank.

    The pattern puts a single blank in front of the run that follows it, so a text may be cut before such blanks. A
    blank next to other white space belongs to a longer run: chunks that are empty or start with white space are None, and
    the text goes the long way. Letters and marks after them are two pieces.
    """

    def __init__(self, ranks: Ranks):
        super().__init__(self.ids, CACHE_CHUNKS)
        self.ranks = ranks

    def ids(self, chunk: bytes, before: bytes = b" ") -> bytes | None:
        if chunk.isalpha():  # of bytes: ASCII letters only
            return array("i", self.ranks.encode_piece(before + chunk)).tobytes()
        text = chunk.decode()
        if not text or text[0].isspace():
            return None
        parts = WORD_AND_MARKS.fullmatch(text)
        if parts is None:
            return array("i", self.ranks.encode(before.decode() + text)).tobytes()
        if not parts[2]:
            return array("i", self.ranks.encode_piece(before + chunk)).tobytes()
        word, marks = parts[1].encode(), array("i", self.ranks.encode_piece(parts[2].encode())).tobytes()
        return (self[word] if before else self.ids(word, before)) + marks


def load_ranks(path: str, pattern: str) -> Ranks:
    """Read a rank file: one token (base64) and its rank per line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return Ranks({base64.b64decode(p[0]): int(p[1]) for p in pairs if p}, pattern)


_RANKS: dict[tuple[str, str], Ranks] = {}


def _ranks(path: str, pattern: str) -> Ranks:
    """Loaded once per worker."""
    claim("bpe", _RANKS.clear)
    if (path, pattern) not in _RANKS:
        _RANKS[path, pattern] = load_ranks(path, pattern)
    return _RANKS[path, pattern]


def _id_lists(ranks: Ranks, texts: list[bytes]) -> pa.ListArray:
    found = [ranks.encode_bytes(t) for t in texts]
    ends = np.cumsum([0, *map(len, found)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))


def _bytes_of(ranks: Ranks, ids: pa.ListArray) -> pa.Array:
    flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist()
    return pa.array([ranks.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.binary())


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All rows and columns, with the ids of the whole text as ``array<int>``.

    Null and empty texts have no ids; a column named ``ids_col`` is replaced.
    """
    out = docs.drop(ids_col)
    columns = out.columns
    schema = out.withColumn(ids_col, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path, pattern)
        for batch in slices(batches):
            ids = _id_lists(ranks, text_bytes(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), ids], names=[*columns, ids_col])

    return out.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """All rows and columns, with the bytes of the ids as ``binary``; null ids give no bytes."""
    out = docs.drop(bytes_col)
    columns = out.columns
    schema = out.withColumn(bytes_col, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path, pattern)
        for batch in slices(batches):
            texts = _bytes_of(ranks, batch.column(columns.index(ids_col)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), texts], names=[*columns, bytes_col])

    return out.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encode`` then ``decode`` of these ids, in one worker per task so that the caches are held once."""
    out = docs.drop(ids_col, bytes_col)
    columns = out.columns
    schema = out.withColumns({ids_col: F.lit(None).cast("array<int>"), bytes_col: F.lit(None).cast("binary")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path, pattern)
        for batch in slices(batches):
            ids = _id_lists(ranks, text_bytes(batch.column(text_col)))
            new = [ids, _bytes_of(ranks, ids)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], names=[*columns, ids_col, bytes_col])

    return out.mapInArrow(run, schema)
