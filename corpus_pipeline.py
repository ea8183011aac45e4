"""The corpus pipeline: rules, classifier, line dedup, near-dedup, packing.

Each stage takes all that the one before kept, and all but the last give the columns of
``documents``. A text that loses lines gets its new ``n_chars``.

Defined cases: each row is judged by itself, also where ids are null or repeat; null and empty texts
have no words, so the rules reject them; other columns pass through unchanged, whatever their names;
texts are read whole; an empty table goes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.common import ROW, numbered, sheltered, table
from rollbook.llm.kneser_ney import quality_classifier
from rollbook.llm.line_dedup import line_dedup
from rollbook.llm.packing import best_fit_packing
from rollbook.llm.quality_rules import quality_rules
from rollbook.llm.queries import tokenizer_path
from rollbook.llm.simhash import keep_one
from rollbook.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    slim, restore = sheltered(docs, "lang", "source", "text")
    return restore(quality_rules(slim, keep_text=True).where("kept"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, each row by its own judgement."""
    slim, restore = sheltered(docs, "doc_id", "lang", "text")
    rows = numbered(slim, "classifier-rows")
    judged = quality_classifier(rows, table(spark, sf_dir, "labels"), row=ROW)
    # Written, so that Spark knows how few they are before it decides whether texts need a shuffle.
    gone = written(judged.where(~F.col("kept")).select(F.col(ROW).alias("_gone")), "classifier-gone")
    return restore(rows.join(gone, F.col(ROW) == F.col("_gone"), "left_anti"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go."""
    slim, restore = sheltered(docs, "doc_id", "text", "n_chars")
    out = line_dedup(slim)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return restore(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return keep_one(docs, shingle=3, distance=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and sequences of what is left."""
    return best_fit_packing(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("best-fit packing", packing),
]

#: Sketches, a trained model and packing have no SQL; ``tests/llm`` checks the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
