"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.ann import nearest
from rollbook.llm.common import table
from rollbook.llm.imatch import imatch_fingerprints
from rollbook.llm.kneser_ney import quality_classifier
from rollbook.llm.line_dedup import line_dedup
from rollbook.llm.max_sketch import ranked_search
from rollbook.llm.packing import best_fit_packing
from rollbook.llm.pieces import piece_digests
from rollbook.llm.pitman_yor import pitman_yor_scores
from rollbook.llm.quality_rules import MEASURES, quality_rules
from rollbook.llm.simhash import simhash_near_dedup
from rollbook.llm.token_files import narrowest, read_token_files, write_token_files
from rollbook.llm.toxicity import toxicity
from rollbook.llm.whitening import whiten


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie, on the driver and on every executor alike."""
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), modulus=5, remainder=0)


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    return best_fit_packing(table(spark, folder, "documents"), path, capacity=2048)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup(table(spark, folder, "documents"), min_docs=10, min_length=1)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_lines", "n_dropped", digest)


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    asks = F.col("vec_id") % 100 == 0
    return nearest(table(spark, folder, "embeddings"), asks, k=10)


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor_scores(table(spark, folder, "documents"), modulus=7, remainder=2)


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    width = narrowest(path)
    files = write_token_files(table(spark, folder, "documents"), path, end_id=2, width=width)
    return read_token_files(files, width)


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_near_dedup(table(spark, folder, "documents"), shingle=3, distance=3)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_rules(table(spark, folder, "documents"))
    return out.select("doc_id", *MEASURES, "base_failed", "kept")


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"), keep=8, scale=1024, shift=100_000)


def op12_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch_fingerprints(table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), top=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_token_files": op8_token_files,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_imatch_fingerprints": op12_imatch_fingerprints,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, rowid AS r, u.i, u.line,
                   translate(regexp_replace(u.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, row_number() OVER () AS rowid,
                         string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
                 LATERAL (SELECT unnest(a) AS line, generate_subscripts(a, 1) AS i) AS u
        ),
        shared AS (
            SELECT key FROM (SELECT DISTINCT doc_id, key FROM lines WHERE length(key) >= 1)
            GROUP BY key HAVING count(*) >= 10
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
               count(*) FILTER (WHERE key IN (SELECT key FROM shared)) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                      FILTER (WHERE key NOT IN (SELECT key FROM shared)), '')) AS kept_sha256
        FROM lines GROUP BY r
    """,
    "op13_ranked_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS occurrences FROM lengths),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term),
        scores AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // occurrences)))) AS BIGINT) AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
            GROUP BY item_id, doc_id),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
