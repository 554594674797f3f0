"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items go into one suffix automaton. A
document's words then stream through it, and at each word the longest suffix that
occurs in some item is known. Where it reaches a window's length the words of
that window are hit, and the automaton's state tells the items.

Items are dealt into chunks of bounded size by a hash, one automaton is built
per chunk in a task, and only one such automaton at a time is broadcast. With one chunk
(the usual case) documents are read once and nothing is shuffled; with more,
each chunk adds its hits to the rows of the chunk before.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import claim, store, slices, text_bytes

#: Words of an item that make a window; a shorter item is one window.
WINDOW = 10
#: Characters of item text per automaton: some 150,000 states at most, which bounds the broadcast to about 20 MB.
CHUNK_CHARS = 400_000

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Runs of word characters cover at least this share of a document before all of it goes.
COVERAGE = 0.8


def words_of(text: bytes) -> list[bytes]:
    """A-Z lowered, then runs of digits, letters and non-ASCII characters."""
    return _WORDS.findall(text.lower())


class Automaton:
    """Suffix automaton over word sequences of several items.

    ``short[s]`` holds (length, items) of items below the window that are
    suffixes of every string of state s or, for its own state, of those at least
    that long; ``full[s]`` the items in which the state's window-long string occurs.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[tuple[int, int]] = []
        for item, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
                ends.append((last, item))
        self._mark_windows(items, ends)

    def _new(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of the strings of q that end p's moves by word; cloned from q if q has longer ones."""
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        state, p = self._new(self.len[last] + 1, {}, -1), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        self.link[state] = 0 if p < 0 else self._split(p, word, self.next[p][word])
        return state

    def _mark_windows(self, items, ends) -> None:
        """Item sets of the states that hold window-long strings, and marks of short items."""
        self.full: dict[int, set[int]] = {}
        seen: set[tuple[int, int]] = set()
        for state, item in ends:
            while state > 0 and self.len[self.link[state]] >= self.window:
                state = self.link[state]
            if self.len[state] >= self.window and (state, item) not in seen:
                seen.add((state, item))
                self.full.setdefault(state, set()).add(item)
        self.short: dict[int, list[tuple[int, set[int]]]] = {}
        for item, words in items:
            if 0 < len(words) < self.window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                marks = self.short.setdefault(state, [])
                same = next((m for m in marks if m[0] == len(words)), None)
                if same:
                    same[1].add(item)
                else:
                    marks.append((len(words), {item}))
        # marks of suffixes hold for all longer strings
        self.below = {}
        if self.short:
            for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
                parent = self.link[s]
                nearest = parent if parent in self.short else self.below.get(parent)
                if nearest:
                    self.below[s] = nearest

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans (start, end) of words inside occurring windows, joined, and the items."""
        moves, link, length = self.next, self.link, self.len
        window, short = self.window, bool(self.short)
        root = moves[0]
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = matched = 0
        for at, word in enumerate(words, 1):
            if not state:
                to = root.get(word)
                if to is None:
                    continue
                state, matched = to, 1
            else:
                to = moves[state].get(word)
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = moves[state].get(word)
                if to is None:
                    continue
                state, matched = to, matched + 1
            if matched >= window:
                inner = state
                while length[link[inner]] >= window:
                    inner = link[inner]
                items |= self.full[inner]
                _add(spans, at - window, at)
            if short:
                self._short_hits(state, matched, at, spans, items)
        return spans, items

    def _short_hits(self, state: int, matched: int, at: int, spans, items) -> None:
        own = self.short.get(state)
        if own:
            for size, found in own:
                if size <= matched:
                    items |= found
                    _add(spans, at - size, at)
        state = self.below.get(state)
        while state:
            for size, found in self.short[state]:
                items |= found
                _add(spans, at - size, at)
            state = self.below.get(state)


def _add(spans: list[tuple[int, int]], start: int, end: int) -> None:
    """Join a span that ends last into ascending disjoint spans."""
    while spans and start <= spans[-1][1]:
        start = min(start, spans.pop()[0])
    spans.append((start, end))


def build_automata(items: DataFrame, window: int = WINDOW, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One pickled automaton per chunk of items: chunk int, automaton binary."""
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-chars // chunk_chars))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parsed = [(int(i), words_of(t.encode())) for i, t in zip(rows["item_id"], rows["text"])]
        return pd.DataFrame({"chunk": [key[0]], "automaton": [pickle.dumps(Automaton(parsed, window))]})

    dealt = (
        items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .select(F.col("item_id").cast("long"), "text")
        .withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)).cast("int"))
    )
    return dealt.groupBy("chunk").applyInPandas(build, "chunk int, automaton binary")


_LOADED: list = []


def _automaton(shared) -> Automaton:
    """The automaton of a broadcast, unpickled once per worker."""
    claim("decontaminate", _LOADED.clear)
    if not _LOADED or _LOADED[0] is not shared:
        _LOADED[:] = [shared, pickle.loads(shared.value)]
    return _LOADED[1]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _join_spans(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def contamination(
    docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``hits`` (spans of words, end exclusive) and ``item_ids``.

    Null or empty text has no words, items without text or id are left out, tied
    and repeated rows are judged one by one, and without items nothing is hit.
    Columns of ``docs`` with the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    automata = store(build_automata(items, window, chunk_chars), "automata")
    out = docs.drop("n_words", "hits", "item_ids")
    columns = out.columns
    out = out.select(
        "*", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(SPANS).alias("hits"),
        F.lit(None).cast("array<long>").alias("item_ids"),
    )
    numbers = [r[0] for r in automata.select("chunk").orderBy("chunk").collect()] or [None]
    for place, number in enumerate(numbers):
        if number is None:
            pickled = pickle.dumps(Automaton([], window))
        else:
            pickled = bytes(automata.where(F.col("chunk") == number).select("automaton").first()[0])
        out = out.mapInArrow(_matcher(spark.sparkContext.broadcast(pickled), columns, text_col), out.schema)
        if place + 1 < len(numbers):
            out = store(out, "contamination")  # one automaton in memory at a time
    return out


def _matcher(shared, columns: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared)
        for batch in slices(batches):
            n_words, hits, ids = [], [], []
            had = zip(batch.column("hits").to_pylist(), batch.column("item_ids").to_pylist())
            for text, (spans, items) in zip(text_bytes(batch.column(text_col)), had):
                words = words_of(text)
                found, whose = automaton.match(words)
                n_words.append(len(words))
                hits.append(_join_spans([(s["start"], s["end"]) for s in spans], found) if spans else found)
                ids.append(sorted({*(items or ()), *whose}))
            spans = pa.array([[{"start": a, "end": b} for a, b in h] for h in hits], _SPANS)
            new = [pa.array(n_words, pa.int64()), spans, pa.array(ids, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], names=[*columns, "n_words", "hits", "item_ids"])

    return run


def n_hit(hits: str = "hits"):
    """Words inside spans."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def remove_spans(marked: DataFrame, text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """Cut the hit words out of the texts of ``contamination`` and drop rows of which hits cover ``coverage`` or more.

    A cut goes from the first to the last word of a span with what stands between them; rows without hits stay as
    they are, null text included. The columns of ``contamination`` go.
    """
    kept = marked.where((n_hit() == 0) | (n_hit() < coverage * F.col("n_words")))
    columns = [c for c in kept.columns if c not in ("n_words", "hits", "item_ids")]
    schema = kept.select(*columns).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, hits in zip(batch.column(text_col).to_pylist(), batch.column("hits").to_pylist()):
                if hits:
                    raw = text.encode()
                    places = [m.span() for m in _WORDS.finditer(raw.lower())]
                    for span in reversed(hits):
                        raw = raw[: places[span["start"]][0]] + raw[places[span["end"] - 1][1]:]
                    text = raw.decode()
                texts.append(text)
            arrays = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return kept.select(*columns, "hits").mapInArrow(cut, schema)
