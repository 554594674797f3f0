"""Secret scan over a trigram inverted index.

From each rule's regular expression a Boolean query of trigrams follows that every
match must satisfy: the parsed pattern is walked and the strings it must contain
become ANDs of trigrams, alternatives become ORs. One pass over the lowered texts
writes postings (trigram, document) for the trigrams the queries name. Intersecting
postings gives candidates (rule, document), which alone are verified with the
expression. A rule without mandatory trigrams scans all documents.

Postings hold no text. Documents are named by id and text hash, so repeated ids do
not mix; a document has at most one posting per trigram, so no key of the
intersection is hot. Only column functions are used.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import empty_if_null, store

#: Most alternative strings that are followed while a query is derived; beyond it a part asks for nothing.
MOST_STRINGS = 16
#: Longest character class that is followed as alternatives.
MOST_CHARACTERS = 4


@dataclass(frozen=True)
class Rule:
    """``least`` bounds the length of ``group`` from below; matches that fail it are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The three base rules (fixed values) and rules with mandatory literals that add spans. ``hex`` is written with its length in
#: the pattern: runs are maximal, so the same matches remain.
RULES = [
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", "[0-9a-f]{16,}", 0, 16, True),
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
    Rule("web_token", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", 0, 1),
    Rule("code_host", "(?:ghp|gho|ghs|ghu)_[A-Za-z0-9]{36}", 0, 1),
    Rule("chat_bot", "xox[abpr]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("url_login", "://[A-Za-z0-9._-]{1,64}:[^@/\\s]{8,128}@", 0, 1),
]

#: A query is an AND of these: each is an OR of AND-sets of trigrams. The empty tuple asks for nothing.
Query = tuple[frozenset[frozenset[str]], ...]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i: i + 3] for i in range(len(text) - 2))


def _strings(node) -> list[str] | None:
    """All strings a node matches if they are few, lowered; else None."""
    op, arg = node
    if op is sre.LITERAL:
        return [chr(arg).lower()]
    if op is sre.IN and arg[0][0] is not sre.NEGATE and all(x[0] is sre.LITERAL for x in arg) and len(arg) <= MOST_CHARACTERS:
        return sorted({chr(x[1]).lower() for x in arg})
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is sre.BRANCH:
        parts = [_sequence_strings(b) for b in arg[1]]
        return None if None in parts else _few(sorted({s for p in parts for s in p}))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] is not sre.MAXREPEAT and arg[1] <= 6:
        inner = _sequence_strings(arg[2])
        if inner is not None:
            return _few(sorted({"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(inner, repeat=n)}))
    return None


def _few(strings: list[str]) -> list[str] | None:
    return strings if len(strings) <= MOST_STRINGS else None


def _sequence_strings(nodes) -> list[str] | None:
    found: list[str] | None = [""]
    for node in nodes:
        part = _strings(node)
        found = None if part is None else _few([a + b for a in found for b in part])
        if found is None:
            return None
    return found


def _any_of(strings: list[str]) -> Query:
    """Any of the strings occurs: nothing is asked where one is too short to have a trigram."""
    sets = frozenset(_trigrams(s) for s in strings)
    return () if frozenset() in sets else (sets,)


def _sequence_query(nodes) -> Query:
    query: Query = ()
    run = [""]
    for node in nodes:
        part = _strings(node)
        longer = None if part is None else _few([a + b for a in run for b in part])
        if longer is not None:
            run = longer
            continue
        query += _any_of(run)
        run = part if part is not None else [""]
        if part is None:
            query += _node_query(node)
    return query + _any_of(run)


def _node_query(node) -> Query:
    op, arg = node
    if op is sre.SUBPATTERN:
        return _sequence_query(arg[3])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
        return _sequence_query(arg[2])
    return ()


def trigram_query(pattern: str) -> Query:
    """What the lowered text of every match must contain."""
    return _sequence_query(sre_parser.parse(pattern))


def _document_key(text_col: str, id_col: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(empty_if_null(text_col)).alias("h"), F.length(empty_if_null(text_col)).alias("n"))


def postings(docs: DataFrame, trigrams: list[str], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """trigram, doc: which documents' lowered texts contain each of the trigrams."""
    low = docs.select(_document_key(text_col, id_col).alias("doc"), F.lower(empty_if_null(text_col)).alias("_low"))
    here = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("doc", F.explode(here).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """kind, doc: documents whose postings satisfy a rule's query.

    Each AND-set is intersected by counting its trigrams, then the sets of one OR are united and the parts of the AND counted.
    """
    terms = [
        (kind, part, choice, trigram, len(grams), len(query))
        for kind, query in queries.items() for part, sets in enumerate(query)
        for choice, grams in enumerate(sorted(sets, key=sorted)) for trigram in sorted(grams)
    ]
    spark = index.sparkSession
    asked = spark.createDataFrame(terms, "kind string, part int, choice int, trigram string, n_grams int, n_parts int")
    hits = index.join(F.broadcast(asked), "trigram")  # one row per trigram of a rule
    sets = hits.groupBy("doc", "kind", "part", "choice", "n_grams", "n_parts").agg(F.countDistinct("trigram").alias("_n"))
    parts = sets.where(F.col("_n") == F.col("n_grams")).groupBy("doc", "kind", "n_parts").agg(F.countDistinct("part").alias("_n"))
    return parts.where(F.col("_n") == F.col("n_parts")).select("doc", "kind")


def _spans(text: Column, rule: Rule) -> Column:
    """Spans (start, end) of the leftmost non-overlapping matches, in code points.

    Matches and the pieces between them alternate, so running sums of their lengths give the places.
    """
    between = F.split(text, rule.pattern)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    size = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,size:int>>").alias("spans"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.length(x["gap"])
        span = F.struct(begin.alias("start"), (begin + F.length(x["match"])).alias("end"), F.length(x["kept"]).alias("size"))
        return F.struct(span["end"].alias("at"), F.array_append(s["spans"], span).alias("spans"))

    pieces = F.zip_with(
        F.slice(between, 1, F.size(whole)), F.zip_with(whole, size, lambda m, k: F.struct(m.alias("match"), k.alias("kept"))),
        lambda g, m: F.struct(g.alias("gap"), m["match"].alias("match"), m["kept"].alias("kept")),
    )
    found = F.aggregate(pieces, start, step, lambda s: s["spans"])
    return F.transform(
        F.filter(found, lambda s: s["size"] >= rule.least),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
    )


_NONE = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _ranked(text: Column, rank: int, rule: Rule) -> Column:
    """Spans of a rule that sort by start, then by the rule's place."""
    return F.transform(
        _spans(text, rule),
        lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")),
    )


def scan(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All rows and columns with ``secrets``: spans (start, rank, kind, end) by start, then rule order.

    Null and empty texts have none; rows with equal id and text get equal spans; a column named ``secrets`` is replaced.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    text = empty_if_null(text_col)
    base = docs.drop("secrets")
    out = base.withColumn("_doc", _document_key(text_col, id_col))
    if indexed:
        grams = sorted({g for q in indexed.values() for sets in q for s in sets for g in s})
        index = store(postings(base, grams, text_col, id_col), "postings")
        chosen = candidates(index.distinct(), indexed).groupBy("doc").agg(F.collect_set("kind").alias("_kinds"))  # at most one per rule
        match = F.col("_doc.id").eqNullSafe(F.col("doc.id")) & (F.col("_doc.h") == F.col("doc.h")) & (F.col("_doc.n") == F.col("doc.n"))
        out = out.join(chosen, match, "left").drop("doc")
    else:
        out = out.withColumn("_kinds", F.lit(None).cast("array<string>"))
    none = F.array().cast(_NONE)
    parts = []
    for rank, rule in enumerate(rules):
        spans = _ranked(text, rank, rule)
        if rule.kind in indexed:
            spans = F.when(F.array_contains("_kinds", rule.kind), spans).otherwise(none)
        else:
            spans = F.when(F.regexp_like(text, F.lit(rule.pattern)), spans).otherwise(none)
        parts.append(F.coalesce(spans, none))
    return out.select(*[F.col(c) for c in base.columns], F.array_sort(F.concat(*parts)).alias("secrets"))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """Texts of ``scan`` with each span, overlapping ones joined, replaced by a mark; ``secrets`` goes. Rows stay."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(s: Column, x: Column) -> Column:
        fresh = x["start"] >= s["at"]
        head = F.substring(F.col(text_col), s["at"] + 1, x["start"] - s["at"])
        done = F.when(fresh, F.concat(s["done"], head, F.lit(mark))).otherwise(s["done"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), done.alias("done"))

    cut = F.aggregate(
        "secrets", start, step, lambda s: F.concat(s["done"], F.substring(F.col(text_col), s["at"] + 1, F.length(text_col))),
    )
    text = F.when(F.size("secrets") > 0, cut).otherwise(F.col(text_col))
    return scanned.withColumn(text_col, text).drop("secrets")
