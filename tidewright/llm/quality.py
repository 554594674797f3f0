"""Quality rules whose thresholds adapt to language and source.

One pass measures each text. Per language and source each measure is summed up in
a relative-error quantile sketch: counts of logarithmic buckets, which merge by
adding (per task before the shuffle, then per group, language and corpus). A
document is kept when each measure lies inside the fences that its group's
quartiles set; small groups borrow the sketch of their language, then that of all
documents. A group's fences lie inside wider ones of its language and, for shares, of
all documents, so that a source full of junk does not set its own standard.
Thresholds join back on the group, one row each.

Only column functions are used. Measures are written once and read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import BLANK, empty_if_null, store

#: Relative error of a quantile.
ERROR = 0.02
#: Rows a group needs for its own thresholds.
LEAST_ROWS = 200
#: A value is out when it lies so many times the distance from the median to a quartile beyond that quartile.
REACH = 8.0
#: The fences of a language and of the corpus bound those of their groups at so many times the distance from the quartile.
BOUND = 2.0
LOW, LOWER, MIDDLE, UPPER, HIGH = 0.05, 0.25, 0.5, 0.75, 0.95
#: Base rules: fewest words, most repeated words in percent. Fixed values.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Words of a window that counts as repeated, and the symbols. Fixed values.
REPEAT_WORDS, SYMBOLS = 8, "#*$%&|<>"
#: Measures that are fenced: whether low values, too, are out, the least distance of a fence from its quartile,
#: so that a group without any spread does not lose each document that differs a little, and whether the corpus
#: bounds the fence, which would be wrong for the length of words and texts, since languages differ in them.
MEASURES = {
    "symbol_share": (False, 0.05, True), "dup_line_share": (False, 0.5, True), "repeat_share": (False, 0.25, True),
    "word_length": (True, 2.0, False), "log_words": (True, 3.0, False),
}


def words_of(text: Column) -> Column:
    """Words between runs of ASCII white space."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _window_hashes(words: Column) -> Column:
    """(hash, place) of each window of 8 words, sorted by hash."""
    places = F.sequence(F.lit(1), F.size(words) - REPEAT_WORDS + 1)
    hashes = F.transform(places, lambda i: F.struct(F.xxhash64(F.slice(words, i, REPEAT_WORDS)).alias("h"), i.alias("i")))
    return F.when(F.size(words) > REPEAT_WORDS, F.array_sort(hashes))


def _repeated_words(sorted_hashes: Column) -> Column:
    """Words inside windows that occur twice or more: a window adds 8 words or the distance to the next one."""
    same = lambda a, b: F.coalesce(F.get(sorted_hashes, a)["h"] == b["h"], F.lit(False))
    twice = F.filter(sorted_hashes, lambda x, i: same(i - 1, x) | same(i + 1, x))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-REPEAT_WORDS).alias("last"))
    total = F.aggregate(
        starts, start,
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(REPEAT_WORDS))).alias("n"), i.alias("last")),
    )
    return total["n"]


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; null text counts as empty.

    Columns of these names are replaced. Windows are compared by 64-bit hash within one text.
    """
    base = docs.drop("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    text = empty_if_null(text_col)
    lines = F.filter(F.split(text, "\n"), lambda s: F.regexp_like(s, F.lit(r"[^\x20\x09-\x0D]")))
    first = base.select(
        "*", words_of(text).alias("_words"), lines.alias("_lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    second = first.select(
        *base.columns, "n_symbols", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col("_words")).alias("_hashes"),
    )
    any_twice = F.size(F.array_distinct(F.transform("_hashes", lambda x: x["h"]))) < F.size("_hashes")
    repeated = F.when(any_twice, _repeated_words(F.col("_hashes"))).otherwise(F.lit(0).cast("long"))
    return second.select(
        *base.columns, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", repeated.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def shares() -> list[Column]:
    """Measures as shares, means and the logarithm of the words; null without words."""
    n, lines = F.nullif("n_words", F.lit(0)), F.nullif("n_lines", F.lit(0))
    return [
        (F.col("n_symbols") / n).alias("symbol_share"), (F.col("n_dup_lines") / lines).alias("dup_line_share"),
        (F.col("n_repeat_words") / n).alias("repeat_share"), (F.col("word_chars") / n).alias("word_length"),
        F.log(n).alias("log_words"),
    ]


def _bucket(value: Column) -> Column:
    """Bucket of a non-negative value; zero has one of its own."""
    gamma = (1 + ERROR) / (1 - ERROR)
    return F.when(value > 0, F.ceil(F.log(value) / F.log(F.lit(gamma)))).otherwise(F.lit(-(1 << 31))).cast("int")


def _bucket_value(bucket: Column) -> Column:
    gamma = (1 + ERROR) / (1 - ERROR)
    return F.when(bucket == -(1 << 31), F.lit(0.0)).otherwise(2 * F.pow(F.lit(gamma), bucket) / (gamma + 1))


def sketch(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Counts per group, measure and bucket. The number of buckets does not grow with the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])).alias("_p")
    return (
        rows.select(*keys, pairs).where(F.col("_p.value").isNotNull())
        .groupBy(*keys, F.col("_p.measure").alias("measure"), _bucket(F.col("_p.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: counts add up."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, quartiles and the low and high quantile of each group and measure: the value of the bucket of rank ceil(q n)."""
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketches.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(group)})

    def at(q: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.ceil(q * F.col("_all")), _bucket_value(F.col("bucket"))))

    return ranked.groupBy(*keys, "measure").agg(
        F.max("_all").alias("rows"), at(LOW).alias("low"), at(LOWER).alias("lower"), at(MIDDLE).alias("middle"),
        at(UPPER).alias("upper"), at(HIGH).alias("high"),
    )


def _wide(found: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row per group: for each measure the fence below and above and the bounds for finer groups, null with too few rows."""
    enough = F.col("rows") >= LEAST_ROWS
    columns = []
    for m, (_, slack, _) in MEASURES.items():
        down = F.greatest(REACH * (F.col("middle") - F.col("lower")), F.lit(slack))
        up = F.greatest(REACH * (F.col("upper") - F.col("middle")), F.lit(slack))
        fences = {
            "below": F.col("lower") - down, "above": F.col("upper") + up,
            "least": F.col("lower") - BOUND * down, "most": F.col("upper") + BOUND * up,
        }
        mine = enough & (F.col("measure") == m)
        columns += [F.max(F.when(mine, fence)).alias(f"{prefix}{m}_{name}") for name, fence in fences.items()]
    return found.groupBy(*keys).agg(*columns)


def _fence(measure: str, side: str, bound: str, by_corpus: bool) -> Column:
    """Fence of the group, else of its language or the corpus, inside the bounds of the coarser ones."""
    own = F.coalesce(*[f"{p}{measure}_{side}" for p in ("_own_", "_lang_", "_all_")])
    bounds = [F.col(f"{p}{measure}_{bound}") for p in (("_lang_", "_all_") if by_corpus else ("_lang_",))]
    return (F.least if side == "above" else F.greatest)(own, *bounds)  # nulls are skipped


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """All rows and columns, the measures, ``base_failed`` and ``kept``.

    Null languages and sources form groups of their own. Texts without words fail the base rule and set no
    threshold, nor do other documents that fail it. Columns of the new names are replaced; without rows
    there are no thresholds and the result is empty.
    """
    base = docs.drop("base_failed", "kept")
    rows = measure(base, text_col)
    keep = [c for c in rows.columns if c != text_col]
    rows = store(rows.select(*keep).select("*", base_failed().alias("base_failed"), *shares()), "measures")
    group = {"_lang": F.coalesce(F.concat(F.lit("="), lang_col), F.lit("")), "_source": F.coalesce(F.concat(F.lit("="), source_col), F.lit(""))}
    rows = rows.withColumns(group)
    fine = store(sketch(rows.where(~F.col("base_failed")), ["_lang", "_source"], list(MEASURES)), "sketches")
    by_lang = merge(fine, ["_lang"])
    marked = (
        rows.join(_wide(quantiles(fine, ["_lang", "_source"]), ["_lang", "_source"], "_own_"), ["_lang", "_source"], "left")
        .join(_wide(quantiles(by_lang, ["_lang"]), ["_lang"], "_lang_"), ["_lang"], "left")
        .join(F.broadcast(_wide(quantiles(merge(by_lang, []), []), [], "_all_")), how="left")  # one row
    )
    inside = F.lit(True)
    for m, (two_sided, _, by_corpus) in MEASURES.items():
        inside &= F.coalesce(F.col(m) <= _fence(m, "above", "most", by_corpus), F.lit(True))
        if two_sided:
            inside &= F.coalesce(F.col(m) >= _fence(m, "below", "least", by_corpus), F.lit(True))
    return marked.select(*keep, "base_failed", (~F.col("base_failed") & inside).alias("kept"))
