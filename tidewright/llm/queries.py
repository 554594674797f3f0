"""Registered queries of the operators, one per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import hard_negatives, jaccard, language, merkle, quality, secret_scan, shards, transcripts, url_filter
from tidewright.llm.block_names import exact_classes
from tidewright.llm.bpe import round_trip
from tidewright.llm.common import store, table
from tidewright.llm.decontaminate import contamination, n_hit
from tidewright.llm.token_file import read_token_file, write_token_file
from tidewright.session import scratch_path


def op1_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Token-id files with Elias-Fano boundaries, written and read back."""
    path = scratch_path(spark, "token-file")
    write_token_file(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    read = read_token_file(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of documents inside windows of benchmark items."""
    marked = contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    items = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return marked.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"), "hits",
    )


def op3_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Turns recovered from raw transcripts of all conversations; the model learns from two thirds of them."""
    raw = store(transcripts.raw_transcripts(table(spark, folder, "conversations")), "transcripts")
    held_out = language.held_out("conv_id")
    model = transcripts.fit(raw.where(~held_out))
    parsed = transcripts.parse(raw, model)
    return parsed.select(
        "conv_id", "segment", held_out.alias("held_out"), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.role"), ",").alias("roles"), F.sha2("canonical", 256).alias("canonical_sha256"), "canonical",
    )


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of whole texts and the bytes that they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = round_trip(table(spark, folder, "documents").select("doc_id", "text"), path, pattern)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each text; learned from rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~language.held_out())
    rows = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return language.identify(rows, model).drop("text")


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of texts that share four fifths of their word 5-grams."""
    return jaccard.similar_components(table(spark, folder, "documents").select("doc_id", "text")).drop("class", "group")


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host rules, then boosted trees on lexical features."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.fit(pages)).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of texts and the verdict of adaptive thresholds."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets by kind."""
    found = secret_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))

    def of(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("secrets")).alias("spans"),
    )


def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of equal counts, written and read back."""
    written = shards.reshard(table(spark, folder, "documents"), 8)
    text = F.coalesce(F.col("text"), F.lit(""))
    return written.select(
        "doc_id", shards.size_of().alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents in trees by source; rows with an even checksum of the id lose their line ends and fail."""
    docs = table(spark, folder, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf, cut = merkle.leaf_digest(*columns, F.col("text")), merkle.leaf_digest(*columns, F.replace("text", F.lit("\n"), F.lit("")))
    leaves = docs.select("doc_id", F.col("source").alias("group"), leaf.alias("digest"), F.when(tampered, cut).otherwise(leaf).alias("again"))
    proven = merkle.manifest(leaves, ["doc_id"])
    names = {"leaf": "digest", "subroot": "subroot", "root": "root"}
    out = proven.select(
        "doc_id", *[F.lower(F.hex(c)).alias(n) for n, c in names.items()], F.sha2(F.array_join(merkle.proof(), ""), 256).alias("proof_sha256"),
        merkle.folded("again").alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector; every seventh label is shifted."""
    vectors = table(spark, folder, "embeddings").where(hard_negatives.usable("label", "embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), hard_negatives.integer_vector("embedding").alias("vec"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of equal texts by block names; the largest id of each stays."""
    return exact_classes(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_file, op2_decontamination, op3_transcripts, op4_byte_bpe, op5_language, op6_jaccard_join, op7_url_filter, op8_quality_rules, op9_secret_scan, op10_shards,
    op11_merkle_manifest, op12_hard_negatives, op13_exact_dedup,
)}
def _merkle_sql() -> str:
    fields = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars")]
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    head = " || ".join(fields) + " || "
    return f"""WITH RECURSIVE
    crc_table AS (SELECT list(list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i)),
    leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({head}{text.format("text")}) AS digest, sha256({head}{text.format("replace(text, chr(10), '')")}) AS cut,
            xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS crc FROM documents, crc_table),
    low AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
    up AS (SELECT tree, 0 AS lvl, idx, n, digest FROM low UNION ALL
        SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
    subroots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
    top AS (SELECT 0 AS lvl, idx, n, subroot AS digest FROM subroots UNION ALL
        SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n),
    path AS (SELECT doc_id, tree, 0 AS lvl, idx, n, '' AS proof, CASE WHEN crc % 2 = 0 THEN cut ELSE digest END AS fold FROM low UNION ALL
        SELECT p.doc_id, p.tree, p.lvl + 1, p.idx // 3, (p.n + 2) // 3, p.proof || coalesce(string_agg(u.digest, '' ORDER BY u.idx) FILTER (WHERE u.idx <> p.idx), ''),
            sha256(string_agg(CASE WHEN u.idx = p.idx THEN p.fold ELSE u.digest END, '' ORDER BY u.idx))
        FROM path p JOIN up u ON u.tree = p.tree AND u.lvl = p.lvl AND u.idx // 3 = p.idx // 3 WHERE p.n > 1 GROUP BY p.doc_id, p.tree, p.lvl, p.idx, p.n, p.proof, p.fold),
    crown AS (SELECT p.doc_id, 0 AS lvl, s.idx, s.n, p.proof, p.fold, s.subroot FROM path p JOIN subroots s USING (tree) WHERE p.n = 1 UNION ALL
        SELECT p.doc_id, p.lvl + 1, p.idx // 3, (p.n + 2) // 3, p.proof || coalesce(string_agg(u.digest, '' ORDER BY u.idx) FILTER (WHERE u.idx <> p.idx), ''),
            sha256(string_agg(CASE WHEN u.idx = p.idx THEN p.fold ELSE u.digest END, '' ORDER BY u.idx)), p.subroot
        FROM crown p JOIN top u ON u.lvl = p.lvl AND u.idx // 3 = p.idx // 3 WHERE p.n > 1 GROUP BY p.doc_id, p.lvl, p.idx, p.n, p.proof, p.fold, p.subroot)
    SELECT doc_id, low.digest AS leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.digest AS verified
    FROM crown JOIN low USING (doc_id), (SELECT digest FROM top WHERE n = 1) t WHERE crown.n = 1"""


#: SQL of the queries that SQL can say.
ORACLE: dict[str, str] = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_hard_negatives": """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        scored AS (SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
            FROM v a JOIN v ON a.vec_id % 100 = 0 AND v.vec_id <> a.vec_id),
        positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM scored JOIN positives USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
        WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 10""",
    "op13_exact_dedup": """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(low) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents) WINDOW same AS (PARTITION BY low)""",
}
