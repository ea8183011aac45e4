"""Upsert, history, dedupe, quality and layout on small literal tables."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rollbook.operators import history, layout, quality
from rollbook.operators.upsert import current_state, upsert
from rollbook.plans import rules

T1, T2, T3 = datetime(2026, 5, 10), datetime(2026, 6, 10), datetime(2026, 7, 10)


def frame(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


# Upsert.


def test_first_upsert_is_the_batch(spark, rows):
    batch = frame(spark, "k string, v int", ("a", 1))
    assert rows(upsert(None, batch, ["k"])) == [("a", 1)]


def test_upsert_replaces_adds_and_keeps(spark, rows):
    target = frame(spark, "k string, v int", ("a", 1), ("b", 2), (None, 9))
    batch = frame(spark, "k string, v int", ("b", 3), ("c", 4), (None, 8))
    expected = [("a", 1), ("b", 3), ("c", 4), (None, 8), (None, 9)]
    assert rows(upsert(target, batch, ["k"])) == expected


def test_upsert_syncs_columns(spark, rows):
    target = frame(spark, "k string, gone int, v int", ("a", 1, 1), ("b", 2, 2))
    batch = frame(spark, "k string, v int, fresh string", ("b", 3, "x"))
    merged = upsert(target, batch, ["k"])
    assert merged.columns == ["k", "v", "fresh"]
    assert rows(merged) == [("a", 1, None), ("b", 3, "x")]


def test_upsert_on_several_keys_and_without(spark, rows):
    target = frame(spark, "a int, b int, v int", (1, 1, 1), (1, 2, 1))
    batch = frame(spark, "a int, b int, v int", (1, 2, 5))
    assert rows(upsert(target, batch, ["a", "b"])) == [(1, 1, 1), (1, 2, 5)]
    with pytest.raises(ValueError, match="key"):
        upsert(target, batch, [])


def test_current_state_keeps_the_newest_row(spark, rows):
    stored = frame(
        spark, "k string, v int, at int", ("a", 1, 1), ("a", 2, 2), ("b", 3, 1), ("b", 2, 1),
        ("c", 1, None), ("c", 2, 1),
    )
    assert rows(current_state(stored, ["k"], ["at"])) == [("a", 2, 2), ("b", 2, 1), ("c", 2, 1)]


# History.

SOURCE = "k string, name string, v int"


def versions(df):
    columns = ("k", "name", "v", history.VALID_FROM, history.VALID_TO)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_first_versions_are_open(spark):
    first = history.first_versions(frame(spark, SOURCE, ("a", "A", 1)), "k", T1)
    assert first.columns == ["k", "name", "v", *history.VERSION_COLUMNS]
    assert versions(first) == [("a", "A", 1, T1, None)]


def test_history_changes(spark):
    before = frame(
        spark, SOURCE, ("change", "A", 1), ("rename", "A", 1), ("same", "A", 1), ("gone", "A", 1),
        ("fill", "A", None), ("empty", "A", 1), ("null", "A", None),
    )
    after = frame(
        spark, SOURCE, ("change", "B", 2), ("rename", "B", 1), ("same", "A", 1), ("new", "A", 1),
        ("fill", "A", 1), ("empty", "A", None), ("null", "A", None),
    )
    first = history.first_versions(before, "k", T1)
    second = history.advance(first, after, "k", ["v"], T2)
    assert versions(second) == sorted(
        [
            ("change", "A", 1, T1, T2), ("change", "B", 2, T2, None),
            ("rename", "A", 1, T1, None),
            ("same", "A", 1, T1, None),
            ("gone", "A", 1, T1, T2),
            ("new", "A", 1, T2, None),
            ("fill", "A", None, T1, T2), ("fill", "A", 1, T2, None),
            ("empty", "A", 1, T1, T2), ("empty", "A", None, T2, None),
            ("null", "A", None, T1, None),
        ],
        key=repr,
    )
    assert quality.repeated_values(second, history.VERSION_ID).count() == 0

    third = history.advance(second, before, "k", ["v"], T3)
    gone = [v for v in versions(third) if v[0] == "gone"]
    assert gone == [("gone", "A", 1, T1, T2), ("gone", "A", 1, T3, None)]
    of_change = history.history_of(third, "k", "change").collect()
    assert [(r.v, r[history.VALID_FROM]) for r in of_change] == [(1, T1), (2, T2), (1, T3)]


def test_nothing_changes_without_changes(spark):
    first = history.first_versions(frame(spark, SOURCE, ("a", "A", 1), ("b", "B", None)), "k", T1)
    again = history.advance(first, first.select("k", "name", "v"), "k", ["v"], T2)
    assert versions(again) == versions(first)


# Data quality.


def test_each_kind_of_rule_counts_its_failures(spark, rows):
    child = frame(
        spark, "k string, c string", ("a", "S"), ("a", "X"), ("b", None), (None, "X"), ("b", "N"),
        ("b", "S"),
    )
    parent = frame(spark, "k string", ("a",), ("z",))
    declared = [
        quality.Rule("child", "k", "not_null"),
        quality.Rule("child", "k", "unique"),
        quality.Rule("child", "c", "accepted_values", values=("S", "N")),
        quality.Rule("child", "k", "relationships", parent=("parent", "k")),
        quality.Rule("parent", "k", "unique"),
        quality.Rule("parent", "k", "relationships", parent=("parent", "k")),
    ]
    summary = quality.check({"child": child, "parent": parent}, declared)
    assert rows(summary) == [
        ("child", "c", "accepted_values", 2),
        ("child", "k", "not_null", 1),
        ("child", "k", "relationships", 3),
        ("child", "k", "unique", 2),
        ("parent", "k", "relationships", 0),
        ("parent", "k", "unique", 0),
    ]
    with pytest.raises(quality.DataQualityError, match="child.k unique: 2"):
        quality.require_clean(summary)
    quality.require_clean(summary.filter("table_name = 'parent'"))


def test_declared_rules():
    kinds = [r.test for r in rules.RULES]
    assert {k: kinds.count(k) for k in kinds} == {
        "not_null": 65, "unique": 12, "accepted_values": 16, "relationships": 5,
    }


FACT = """company_root_cnpj string, active_company_count int, active_establishment_count int,
    active_headquarters_count int, active_branch_count int, share_capital_amount decimal(18,2),
    partner_count int, legal_entity_partner_count int, individual_partner_count int,
    foreign_partner_count int"""


@pytest.mark.parametrize(
    ("change", "broken"),
    [
        ({}, False),
        ({"active_company_count": 2}, True),
        ({"active_establishment_count": 0}, True),
        ({"active_branch_count": 1}, True),
        ({"active_headquarters_count": 4, "active_branch_count": -1}, True),
        ({"active_headquarters_count": -1, "active_branch_count": 4}, True),
        ({"share_capital_amount": -1}, True),
        ({"partner_count": 7}, True),
        ({"partner_count": None}, False),
        ({"partner_count": None, "share_capital_amount": -1}, True),
    ],
)
def test_business_rule(spark, change, broken):
    row = frame(spark, FACT, ("a", 1, 3, 1, 2, None, 6, 1, 2, 3))
    row = row.withColumns({c: F.lit(v).cast(row.schema[c].dataType) for c, v in change.items()})
    assert rules.inconsistent_active_companies(row).count() == broken


# Layout.


def stamped(spark, release, *values):
    return layout.with_run_metadata(
        frame(spark, "k string, n string", *values), datetime(2026, 6, 20), release, "run_" + release[:4]
    )


def test_releases_replace_themselves_and_prune(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    layout.write_release(stamped(spark, "2026-05-10", ("a", "1"), ("b", "x")), path, ["k"])
    layout.write_release(stamped(spark, "2026-06-10", ("a", "2")), path)
    layout.write_release(stamped(spark, "2026-06-10", ("a", "3"), ("c", "4")), path)
    stored = layout.read_release(spark, path)
    assert rows(stored.select("k", "n")) == [("a", "1"), ("a", "3"), ("b", "x"), ("c", "4")]
    one = layout.read_release(spark, path, "2026-06-10")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_source_reference_date" in plan
    sizes = layout.bytes_by_partition(spark, path).collect()
    assert len(sizes) == 2 and all(r.bytes > 0 and r.files > 0 for r in sizes)
    counts = layout.row_counts_by_run(stored, "s").collect()
    assert {(str(r._source_reference_date), r.row_count) for r in counts} == {
        ("2026-05-10", 2), ("2026-06-10", 2),
    }
    fresh = layout.freshness(stored, "s", "2026-07-01").first()
    assert tuple(fresh) == ("s", date(2026, 6, 10), 21)
    late = layout.invalid_and_late(stored, {"n": F.col("n").try_cast("int")}, 15)
    assert rows(late) == [(date(2026, 5, 10), 1, 2), (date(2026, 6, 10), 0, 0)]


def test_clustering_spreads_a_hot_value(spark):
    """Rows equal in every clustering column still go to several partitions."""
    hot = spark.range(0, 40_000, 1, 8).select(F.lit("SP").alias("state"), F.lit(1).alias("v"))
    sizes = (
        layout.clustered(hot, ["state"], 4)
        .groupBy(F.spark_partition_id())
        .count()
        .select("count")
        .collect()
    )
    assert len(sizes) > 1 and sum(r[0] for r in sizes) == 40_000
