"""The pipeline's stages one after another against what each stage alone must do."""

from __future__ import annotations

import corpus_pipeline
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rollbook.llm.line_dedup import line_dedup
from rollbook.llm.quality_rules import RESULTS, quality_rules
from rollbook.llm.simhash import simhash_near_dedup
from rollbook.session import written


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SMALL), name.replace(" ", "-")))
    return out


def test_all_but_the_last_stage_return_documents(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_filters_keep_whole_rows_of_their_input(steps):
    for before, after in ((steps[0], steps[1]), (steps[1], steps[2]), (steps[3], steps[4])):
        assert after.exceptAll(before).count() == 0


def test_clean_documents_stay_and_junk_goes(spark, steps):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    long_enough = steps[0].where(F.size(F.split("text", r"\s+")) >= 25)
    good = long_enough.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert good.join(steps[2], "doc_id", "left_anti").count() <= 0.02 * good.count()
    junk = steps[0].join(labels.where("quality = 0"), "doc_id", "left_semi")
    assert junk.join(steps[2], "doc_id", "left_semi").count() <= 0.3 * junk.count()


def test_one_document_of_each_group_stays(steps):
    groups = simhash_near_dedup(steps[3]).select("component_id").distinct()
    assert {r[0] for r in groups.collect()} == {r[0] for r in steps[4].select("doc_id").collect()}


def test_every_document_left_is_packed(spark, steps):
    packed = {r[0] for r in steps[5].select("doc_id").distinct().collect()}
    assert packed == {r[0] for r in steps[4].select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SMALL).count() == steps[5].count()


def test_rows_with_null_or_repeated_ids_are_judged_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    clean = docs.join(spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
    texts = [r.text for r in clean.where("lang = 'en'").orderBy(F.length("text").desc()).limit(25).collect()]
    good = texts[::7]
    junk = " ".join("zqxj#kv" + "wqz"[i % 3] * 9 for i in range(200))
    rows = [(None, t, "en") for t in good[:2]] + [(-7, t, "en") for t in good[2:]] + [(None, junk, "en"), (-7, junk, "en")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.classifier(spark, docs.unionByName(odd), SMALL).where("doc_id IS NULL OR doc_id = -7")
    assert sorted(r.text for r in left.collect()) == sorted(good)
    one = corpus_pipeline.near_duplicates(spark, odd, SMALL).collect()
    assert sorted(r.text for r in one) == sorted([*good, junk])
    assert [r.doc_id for r in one if r.text == junk] == [-7]


HOSTILE = [
    "_lines", "_shared", "_rest", "_slots", "_own", "_lang", "_l", "_s", "_k", "_words", "_whole", "_kept", "_gone", "_row", "_id",
    "_carried", "n_words", "kept", "n_dropped", "n_lines", "base_failed", "root", "fp", "flag", "a.b", "row", "batch", "keys",
]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_pass_on_columns_of_any_name(spark, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0 if empty else 60)
    docs = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in HOSTILE])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert bool(rows) != empty
        for r in rows:
            assert all(r[c] == f"{c}:{r.doc_id}" for c in HOSTILE), name
    packed = corpus_pipeline.packing(spark, docs, SMALL).select("doc_id").distinct().count()
    assert packed == (0 if empty else 60)
    for out, results in (
        (line_dedup(docs), ("n_lines", "n_dropped")),
        (quality_rules(docs), RESULTS),
    ):
        others = [c for c in HOSTILE if c not in results]
        assert set(others) < set(out.columns)
        assert all(r[c] == f"{c}:{r.doc_id}" for r in out.collect() for c in others)
