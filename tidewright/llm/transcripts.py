"""Roles of raw transcripts by a hidden Markov model, and canonical turns.

Each line of a transcript is an observation: its speaker marker (``User:``, ``### Assistant``, ``<|system|>``, ``[A]``;
hashed, so unknown speakers have a place too), whether it is blank, asks, is long, opens in lower case, and is the first
line. Hidden states are the first and the further lines of a turn of each role. Start, transition and emission
counts come from transcripts with known line states; Viterbi finds the likeliest states of a new one, and
runs of them become turns in one canonical form.

A transcript is one row and is decoded in one task in time linear in its lines; nothing is grouped. The
model's size is fixed by roles and feature values, and only its counts reach the driver.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import slices

ROLES = ("system", "user", "assistant")
#: State 2r opens a turn of role r, state 2r + 1 continues it.
STATES = 2 * len(ROLES)
#: Hashed speaker markers; 0 is no marker.
MARKERS = 65
#: Feature name: number of values.
FEATURES = {"marker": MARKERS, "blank": 2, "asks": 2, "length": 6, "lower": 2, "first": 2}
SMOOTHING = 0.1
#: Turn numbers of a conversation that make one transcript.
SEGMENT_TURNS = 64

_MARK = re.compile(r"\s*(?:<\|\s*([^\W\d_]{1,20})\s*\|>|#{1,4}\s*([^\W\d_]{1,20})\s*:?(?=\s|$)|\[([^\W\d_]{1,20})\]|\**([^\W\d_]{1,20})\**\s?:)\**[ \t]*")
#: Styles in which ``raw_transcripts`` writes system, user and assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "), ("SYSTEM: ", "Human: ", "AI: "), ("### System\n", "### User\n", "### Assistant\n"),
    ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"), ("[S] ", "[Q] ", "[A] "), ("**Note**: ", "**Q**: ", "**A**: "),
)


def marker_of(line: str) -> tuple[str | None, str]:
    """Speaker word in lower case, if the line opens with one, and the rest of the line."""
    found = _MARK.match(line)
    return (next(g for g in found.groups() if g).lower(), line[found.end():]) if found else (None, line)


def observations(lines: list[str]) -> np.ndarray:
    """One row per line, one column per feature."""
    rows = np.zeros((len(lines), len(FEATURES)), np.int64)
    for i, line in enumerate(lines):
        word, rest = marker_of(line)
        rest = rest.strip()
        rows[i] = (
            0 if word is None else 1 + zlib.crc32(word.encode()) % (MARKERS - 1), not line.strip(), rest.endswith("?"),
            min(5, len(rest).bit_length() // 2), rest[:1].islower(), i == 0,
        )
    return rows


@dataclass(frozen=True)
class RoleModel:
    """Logarithms of start, transition and emission probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]

    def states(self, lines: list[str]) -> np.ndarray:
        """Likeliest states; of equal paths the one through smaller states."""
        seen = observations(lines)
        score = sum(table[:, seen[:, k]].T for k, table in enumerate(self.emit))
        back = np.zeros(score.shape, np.int8)
        now = self.start + score[0]
        for i in range(1, len(lines)):
            paths = now[:, None] + self.move
            back[i] = paths.argmax(0)
            now = paths.max(0) + score[i]
        found = np.empty(len(lines), np.int64)
        found[-1] = now.argmax()
        for i in range(len(lines) - 1, 0, -1):
            found[i - 1] = back[i, found[i]]
        return found

    def turns(self, text: str | None) -> list[tuple[str, str]]:
        """(role, text) of each turn without its marker; none for null and blank texts."""
        if text is None or not text.strip():
            return []
        lines = text.split("\n")
        out: list[tuple[str, list[str]]] = []
        for line, state in zip(lines, self.states(lines).tolist()):
            role = ROLES[state // 2]
            if state % 2 == 0 or not out or out[-1][0] != role:
                out.append((role, [marker_of(line)[1]]))
            else:
                out[-1][1].append(line)
        return [(role, "\n".join(body).strip()) for role, body in out]


def canonical(turns: list[tuple[str, str]]) -> str:
    """Turns in the canonical form."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def fit(labelled: DataFrame, text_col: str = "text", states_col: str = "line_states") -> RoleModel:
    """Model from texts and the states of their lines. Rows whose numbers of lines and states differ, or with nulls, teach nothing."""
    schema = pa.schema([("table", pa.int32()), ("row", pa.int32()), ("value", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _empty_tables()
        for batch in slices(batches):
            for text, states in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = (text or "").split("\n")
                if states and len(states) == len(lines) and None not in states:
                    tables[0][0, states[0]] += 1
                    np.add.at(tables[1], (states[:-1], states[1:]), 1)
                    for k, values in enumerate(observations(lines).T):
                        np.add.at(tables[2 + k], (states, values), 1)
        for t, table in enumerate(tables):
            row, value = np.nonzero(table)
            columns = [np.full(len(row), t), row, value, table[row, value]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    counts = labelled.select(text_col, states_col).mapInArrow(count, "table int, row int, value int, n long")
    tables = _empty_tables()
    for t, row, value, n in counts.groupBy("table", "row", "value").agg(F.sum("n")).collect():  # a fixed number of cells
        tables[t][row, value] = n
    logs = [np.log((t + SMOOTHING) / (t + SMOOTHING).sum(1, keepdims=True)) for t in tables]
    return RoleModel(logs[0][0], logs[1], logs[2:])


def _empty_tables() -> list[np.ndarray]:
    return [np.zeros((1, STATES), np.int64), np.zeros((STATES, STATES), np.int64), *(np.zeros((STATES, n), np.int64) for n in FEATURES.values())]


TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def parse(transcripts: DataFrame, model: RoleModel, text_col: str = "text") -> DataFrame:
    """All rows and columns with ``turns`` and ``canonical``; null and blank texts have no turns and an empty canonical text.

    Repeated rows are parsed alike; columns of the new names are replaced.
    """
    out = transcripts.drop("turns", "canonical")
    columns = out.columns
    schema = out.withColumns({"turns": F.lit(None).cast(TURNS), "canonical": F.lit("")}).schema
    shared = transcripts.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = RoleModel(*shared.value)
        for batch in slices(batches):
            found = [local.turns(t) for t in batch.column(text_col).to_pylist()]
            turns = pa.array([[{"role": r, "text": t} for r, t in f] for f in found], _TURNS)
            new = [turns, pa.array([canonical(f) for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], names=[*columns, "turns", "canonical"])

    return out.mapInArrow(run, schema)


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """conv_id, segment, text, line_states: conversations written as raw text in mixed styles.

    A conversation's style and the one turn in eight that lacks its marker follow from hashes of ids. Turns of unknown
    role, without text or number are left out; repeated turns are written once; turns without conv_id are transcripts of their own.
    Conversations are cut after 64 turn numbers.
    """
    rows = (
        turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
        .where(F.col("role").isin(*ROLES) & F.col("text").isNotNull() & F.col("turn").isNotNull())
        .distinct()
    )
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    grouped = (
        rows.groupBy("conv_id", F.floor(F.col("turn") / SEGMENT_TURNS).alias("segment"), alone.alias("_alone"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .select("conv_id", "segment", "turns")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, states = [], []
            for conv, found in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                text, state = _raw(conv, found)
                texts.append(text)
                states.append(state)
            new = [pa.array(texts, pa.string()), pa.array(states, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names=["conv_id", "segment", "text", "line_states"])

    kind = dict(rows.dtypes)["conv_id"]
    return grouped.mapInArrow(run, f"conv_id {kind}, segment long, text string, line_states array<int>")


def _raw(conv, turns: list[dict]) -> tuple[str, list[int]]:
    style = STYLES[zlib.crc32(f"style:{conv}".encode()) % len(STYLES)]
    parts, states = [], []
    for t in turns:
        role = ROLES.index(t["role"])
        bare = zlib.crc32(f"bare:{conv}:{t['turn']}".encode()) % 8 == 0
        part = ("" if bare else style[role]) + t["text"]
        parts.append(part)
        states += [2 * role] + [2 * role + 1] * part.count("\n")
    return "\n".join(parts), states
