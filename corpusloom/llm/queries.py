"""The queries of these operators over the driver's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, language, linededup, packing, pii, quality, sharding, simhash, toxicity
from .common import fold, read


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    ranks, pattern = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    encoded = bpe.encode_documents(read(spark, sf_dir, "documents"), ranks, pattern)
    decoded = bpe.decode_documents(encoded, ranks, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("passed")).alias("kept"), "n_lines", "n_stop_words"
    )


SHARDS = 40


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.reshard(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs.filter(fold(5) != 0), labels.filter(fold(5) != 0))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return packing.pack_documents(read(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.remove_boilerplate(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "n_chars", "n_removed")


_WHITE = " || ".join(f"chr({ord(c)})" for c in linededup.WHITE)
OP8_SQL = f"""
WITH l AS (SELECT doc_id, source, pos, line, length(translate(line, {_WHITE}, '')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
b AS (SELECT line, min(doc_id) AS owner FROM l WHERE n > 0 GROUP BY line
  HAVING count(DISTINCT source) >= CASE WHEN max(n) >= {linededup.SHORT} THEN {linededup.MIN_SITES} ELSE {linededup.SHORT_SITES} END),
k AS (SELECT l.doc_id, l.pos, l.line, b.line IS NOT NULL AND l.doc_id <> b.owner AS gone FROM l LEFT JOIN b ON l.line = b.line),
t AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed FROM k GROUP BY doc_id)
SELECT d.doc_id, md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END) AS text_md5,
  CAST(length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END) AS BIGINT) AS n_chars, coalesce(t.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id
"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs.filter(fold(4) != 2).select("text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = [F.size(F.array_remove(F.transform("base_spans", lambda x: x["kind"]), k)) for k in pii.KINDS]
    counts = [(F.size("base_spans") - c).cast("long").alias(f"n_{k}") for k, c in zip(pii.KINDS, counts, strict=True)]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base_spans")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
OP3_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ 	-
]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls FROM d),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[ 	-
]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(len(list_filter(ws, lambda x: trim(lower(x), '.,;:!?"''()') IN ({_STOP}))) AS BIGINT) AS n_stop_words FROM w),
g AS (SELECT doc_id, i, ws[i:i + 7] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, CAST(sum(least(8, coalesce(nxt - i, 8))) AS BIGINT) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id),
a AS (SELECT m.*, coalesce(c.n, 0) AS n_repeat_words FROM m LEFT JOIN c ON m.doc_id = c.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        CASE WHEN n_words = 0 THEN 0.0 ELSE word_chars / CAST(n_words AS DOUBLE) END AS wl, CASE WHEN n_words = 0 THEN 0.0 ELSE n_symbols / CAST(n_words AS DOUBLE) END AS sy,
        CASE WHEN n_words = 0 THEN 0.0 ELSE n_stop_words / CAST(n_words AS DOUBLE) END AS st, CASE WHEN n_lines = 0 THEN 0.0 ELSE n_dup_lines / CAST(n_lines AS DOUBLE) END AS du,
        CASE WHEN n_words = 0 THEN 0.0 ELSE n_repeat_words / CAST(n_words AS DOUBLE) END AS rp FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 20 AND wl BETWEEN 2 AND 20 AND sy <= 0.25 AND st >= 0.02 AND du <= 0.5 AND rp <= 0.3 AS kept, n_lines, n_stop_words FROM b
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_byte_bpe": op1_byte_bpe, "op2_simhash": op2_simhash, "op3_quality_rules": op3_quality_rules, "op4_sharding": op4_sharding, "op5_toxicity": op5_toxicity, "op6_packing": op6_packing, "op7_fingerprint": op7_fingerprint, "op8_line_dedup": op8_line_dedup, "op9_language": op9_language, "op10_pii": op10_pii}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": OP3_SQL, "op8_line_dedup": OP8_SQL}
