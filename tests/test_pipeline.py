"""Ingest, build, history and checks through the published tables, over two releases."""

from __future__ import annotations

import csv
import glob
import io
import zipfile
from datetime import datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from checks import queries as checked
from checks.archives import archived
from checks.register import Register
from rollbook.operators.quality import DataQualityError
from rollbook.plans.ingest import Run, Source, current_raw, ingest, register_source, select_sources
from rollbook.plans.pipeline import run_pipeline
from rollbook.plans.schemas import RAW_COLUMNS, ROOT, raw_table
from rollbook.plans.warehouse import OutOfOrderError, Warehouse
from rollbook.sources import landing
from rollbook.sources.formats import read_source

FIRST = Run("r1", datetime(2026, 5, 10), "2026-05-10")
SECOND = Run("r2", datetime(2026, 6, 10), "2026-06-10")


@pytest.fixture(scope="module")
def register(spark):
    return Register(spark, SMALL)


@pytest.fixture(scope="module")
def archives(register):
    """Archives of the first release by source, and of the second release's companies."""
    folders = {s: archived(register.raw(s), 2) for s in RAW_COLUMNS}
    second = archived(register.raw_companies(1), 2)
    return folders, second


def declared(archives, release=1, **strategies):
    folders = dict(archives[0])
    if release == 2:
        folders["companies"] = archives[1]
    return [
        register_source(s, f"{folders[s]}/*.zip", strategies.get(s, "overwrite")) for s in folders
    ]


@pytest.mark.parametrize("buckets", [None, 4])
def test_two_runs(spark, rows, register, archives, buckets):
    warehouse = Warehouse(spark, f"two_runs_{buckets or 0}", buckets)
    first = run_pipeline(warehouse, declared(archives), FIRST, raise_on_failure=False)
    assert [r["row_count"] for r in first["ingestion"]] == [
        register.raw(s).count() for s in RAW_COLUMNS
    ]
    assert rows(warehouse.read("fct_active_companies")) == rows(register.fact)
    name = "int_company_registry__company_profile"
    assert rows(warehouse.read(name)) == rows(register.profile)
    failures = {
        (r.table_name, r.column_name, r.test_name): r.failures
        for r in first["checks"].filter("failures > 0").collect()
    }
    assert ("stg_establishments", "registration_status_code", "accepted_values") in failures
    assert not any(test == "unique" for _, _, test in failures)

    first_roots = {r[0] for r in warehouse.read("fct_active_companies").select(ROOT).collect()}
    run_pipeline(warehouse, declared(archives, 2), SECOND, raise_on_failure=False)
    history = warehouse.read("snap_company_registry__share_capital")
    from checks.queries import QUERIES

    expected = QUERIES["scd2_second_release"](spark, SMALL)
    assert rows(history.select(*expected.columns)) == rows(expected)
    fact_roots = {r[0] for r in warehouse.read("fct_active_companies").select(ROOT).collect()}
    assert first_roots <= fact_roots

    # The same run once more changes nothing.
    before = rows(history)
    run_pipeline(warehouse, declared(archives, 2), SECOND, raise_on_failure=False)
    assert rows(warehouse.read("snap_company_registry__share_capital")) == before


def test_failed_checks_raise(spark, archives):
    with pytest.raises(DataQualityError, match="registration_status_code accepted_values"):
        run_pipeline(Warehouse(spark, "failing"), declared(archives), FIRST)


def test_one_source_is_only_ingested(spark, archives):
    warehouse = Warehouse(spark, "one_source")
    result = run_pipeline(warehouse, declared(archives), FIRST, source_name="cnaes")
    assert [r["source_name"] for r in result["ingestion"]] == ["cnaes"] and not result["tables"]
    assert warehouse.exists(raw_table("cnaes")) and not warehouse.exists("dim_cnaes")


def test_row_limit_counts_all_rows_and_needs_a_sample(spark, archives):
    run = Run("r1", FIRST.run_time, FIRST.source_reference_date, row_limit=7)
    warehouse = Warehouse(spark, "limited", sample=True)
    assert ingest(warehouse, declared(archives)[0], run)["row_count"] == 7
    whole = Warehouse(spark, "not_limited")
    with pytest.raises(ValueError, match="sample"):
        run_pipeline(whole, declared(archives), run)
    assert not whole.exists(raw_table("companies"))


def test_row_limit_is_the_same_for_all_formats(spark, tmp_path, archives):
    rows = spark.range(20).selectExpr("cast(id as string) as a").repartition(2)
    rows.write.option("header", True).csv(f"{tmp_path}/csv")
    rows.write.json(f"{tmp_path}/json")
    assert read_source(spark, "csv", f"{tmp_path}/csv", {}, 2).count() == 2
    assert read_source(spark, "json", f"{tmp_path}/json", {"columns": ["a"]}, 2).count() == 2
    options = declared(archives)[0].options
    assert read_source(spark, "zip_csv", declared(archives)[0].uri, options, 2).count() == 2


def test_append_only_keeps_runs_and_replaces_a_repeated_one(spark, rows, register, archives):
    warehouse = Warehouse(spark, "appended")
    for release, run in ((1, FIRST), (2, SECOND), (2, SECOND)):
        source = next(s for s in declared(archives, release, companies="append_only") if s.name == "companies")
        result = ingest(warehouse, source, run)
    counts = [register.raw_companies(r).count() for r in (0, 1)]
    assert result["row_count"] == counts[1]
    stored = warehouse.read(raw_table("companies"))
    assert stored.count() == sum(counts)
    assert {"_loaded_at", "_source_reference_date", "_pipeline_run_id"} <= set(stored.columns)
    # A release is whole: companies that are not in the second one are gone.
    current = current_raw(warehouse, source)
    assert rows(current) == rows(register.raw_companies(1).dropDuplicates([ROOT]))
    assert all("_source_reference_date=2026-06-10" in file for file in current.inputFiles())


def test_append_only_without_key_reads_the_newest_run(spark, rows, register, archives):
    warehouse = Warehouse(spark, "appended_simples")
    source = next(s for s in declared(archives, simples="append_only") if s.name == "simples")
    for run in (FIRST, SECOND):
        ingest(warehouse, source, run)
    assert rows(current_raw(warehouse, source)) == rows(register.raw("simples"))


def test_upsert_strategy(spark, rows, register, archives):
    warehouse = Warehouse(spark, "upserted")
    for release, run in ((1, FIRST), (2, SECOND)):
        source = next(s for s in declared(archives, release, companies="upsert") if s.name == "companies")
        ingest(warehouse, source, run)
    from rollbook.operators.upsert import upsert

    expected = upsert(register.raw_companies(0), register.raw_companies(1), [ROOT])
    assert rows(warehouse.read(raw_table("companies"))) == rows(expected)


def test_old_versions_are_dropped_but_the_last(spark):
    warehouse = Warehouse(spark, "versions")
    for run in ("r1", "r2", "r3"):
        warehouse.publish("t", spark.range(3), run)
    names = {t.name[:7] for t in spark.catalog.listTables("versions") if not t.isTemporary}
    assert names == {"t", "t__v_r2", "t__v_r3"}
    assert warehouse.version_before("t", "r3").count() == 3
    kept = Warehouse(spark, "versions", keep=3)
    for run in ("r4", "r5"):
        kept.publish("t", spark.range(3), run)
    names = {t.name[:7] for t in spark.catalog.listTables("versions") if not t.isTemporary}
    assert names == {"t", *(f"t__v_r{i}" for i in (2, 3, 4, 5))}


def failing(spark):
    return spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))


def test_failed_repeat_leaves_the_table(spark, rows):
    warehouse = Warehouse(spark, "failed_repeat")
    warehouse.publish("t", spark.range(3), "r1")
    for run in ("r1", "r2"):
        with pytest.raises(Exception, match="stop"):
            warehouse.publish("t", failing(spark), run)
        assert rows(warehouse.read("t")) == [(0,), (1,), (2,)]
    assert spark.sql("SHOW TABLES IN failed_repeat LIKE 't__v_*'").count() == 1
    warehouse.publish("t", spark.range(1), "r1")
    assert rows(warehouse.read("t")) == [(0,)]


def test_older_runs_are_refused(spark, rows):
    warehouse = Warehouse(spark, "older_runs")
    for run, day in (("r1", 1), ("r2", 2)):
        warehouse.publish("t", spark.range(day), run, moment=datetime(2026, 1, day))
    for run, day in (("r1", 1), ("late", 1), ("same", 2)):
        with pytest.raises(OutOfOrderError):
            warehouse.publish("t", spark.range(9), run, moment=datetime(2026, 1, day))
        with pytest.raises(OutOfOrderError):
            warehouse.version_before("t", run, datetime(2026, 1, day))
    assert warehouse.read("t").count() == 2


def test_an_empty_repeat_replaces_rows(spark):
    warehouse = Warehouse(spark, "empty_repeat")
    batch = spark.range(3).selectExpr("id", "date '2026-01-01' AS _source_reference_date", "'r1' AS _pipeline_run_id")
    for part, n in ((batch, 3), (batch.limit(0), 0), (batch.limit(1), 1), (batch.limit(2), 2)):
        warehouse.append("t", part, "r1", datetime(2026, 1, 1), "2026-01-01")
        assert warehouse.read("t").count() == n
    # What is shown and what was shown before it.
    assert spark.sql("SHOW PARTITIONS empty_repeat.t__rows").count() == 2


@pytest.mark.parametrize("buckets", [None, 2])
def test_repeated_history(spark, rows, buckets):
    warehouse = Warehouse(spark, f"repeated_history_{buckets or 0}", buckets)

    def step(run, day, *values):
        source = spark.createDataFrame(list(values), "k string, v long")
        warehouse.advance_history("h", source, "k", ["v"], run, datetime(2026, 1, day))

    def seen():
        return rows(warehouse.read("h").selectExpr("k", "v", "day(dbt_valid_from)", "day(dbt_valid_to)"))

    step("r1", 1, ("a", 1), ("b", 1))
    step("r2", 2, ("a", 2))
    assert seen() == [("a", 1, 1, 2), ("a", 2, 2, None), ("b", 1, 1, 2)]
    # The corrected file closes nothing.
    step("r2", 2, ("a", 1), ("b", 1))
    assert seen() == [("a", 1, 1, None), ("b", 1, 1, None)]
    step("r3", 3, ("a", 3), ("b", 1))
    expected = [("a", 1, 1, 3), ("a", 3, 3, None), ("b", 1, 1, None)]
    assert seen() == expected
    for run, day in (("r2", 2), ("r4", 2), ("r4", 3)):
        with pytest.raises(OutOfOrderError):
            step(run, day, ("a", 9))
    with pytest.raises(Exception, match="stop"):
        source = failing(spark).selectExpr("string(id) AS k", "id AS v")
        warehouse.advance_history("h", source, "k", ["v"], "r3", datetime(2026, 1, 3))
    assert seen() == expected
    ids = warehouse.read("h").select("dbt_scd_id")
    assert ids.distinct().count() == ids.count()


def test_declarations():
    declaration = {
        "name": "companies",
        "extractor": "http_zip_csv",
        "uri": "https://example.org/Companies1.zip",
        "load": {"target_table": "raw_companies", "strategy": "append-only", "unique_key": ["k"]},
        "options": {"delimiter": ";"},
    }
    source = Source.from_declaration(declaration)
    assert (source.strategy, source.unique_key) == ("append_only", ("k",))
    plain = {"name": "a", "extractor": "csv", "uri": "x", "target_table": "t"}
    assert Source.from_declaration(plain).strategy == "overwrite"
    for load, message in (
        ({"target_table": "t", "strategy": "truncate"}, "no way to load"),
        ({"target_table": "t; drop"}, "cannot be the name"),
        ({"target_table": "t", "strategy": "upsert"}, "unique_key"),
    ):
        with pytest.raises(ValueError, match=message):
            Source.from_declaration({**declaration, "load": load})
    assert select_sources([source], None) == select_sources([source], "companies") == [source]
    with pytest.raises(ValueError, match="only companies"):
        select_sources([source], "partners")


def fact_rows(spark, changed=(), gone=(), n=200):
    rows = [(f"{i:04d}", i * (10 if i in changed else 1), None if i % 5 else "x") for i in range(n) if i not in gone]
    return spark.createDataFrame(rows, "k string, v long, w string")


def partitions(spark, table):
    return {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_a_merge_rewrites_only_slices_that_change(spark, rows):
    warehouse = Warehouse(spark, "merged", slices=8)
    whole = fact_rows(spark)
    warehouse.merge("t", whole, "k", "r1", datetime(2026, 1, 1))
    first = partitions(spark, "merged.t__slices")
    assert len(first) == 8 and rows(warehouse.read("t")) == rows(whole)
    # Nothing changed: nothing is written.
    warehouse.merge("t", whole, "k", "r2", datetime(2026, 1, 2))
    assert partitions(spark, "merged.t__slices") == first
    # One key changed and some are gone from the batch: one slice more, and gone keys stay.
    warehouse.merge("t", fact_rows(spark, changed={7}, gone={3, 4}), "k", "r3", datetime(2026, 1, 3))
    third = partitions(spark, "merged.t__slices")
    assert len(third - first) == 1 and first <= third
    assert rows(warehouse.read("t")) == rows(fact_rows(spark, changed={7}))
    assert len(warehouse.read("t").inputFiles()) == 8
    # The same run again, corrected: computed from the state before it.
    warehouse.merge("t", fact_rows(spark, changed={9}), "k", "r3", datetime(2026, 1, 3))
    assert rows(warehouse.read("t")) == rows(fact_rows(spark, changed={9}))
    with pytest.raises(OutOfOrderError):
        warehouse.merge("t", whole, "k", "r2", datetime(2026, 1, 2))
    # Superseded partitions go once no kept state shows them.
    for n in (4, 5, 6):
        warehouse.merge("t", fact_rows(spark, changed={9, n}), "k", f"r{n}", datetime(2026, 1, n))
    assert rows(warehouse.read("t")) == rows(fact_rows(spark, changed={9, 6}))
    assert len(partitions(spark, "merged.t__slices")) <= 8 + 3
    assert Warehouse(spark, "merged", slices=3).merge("t", whole, "k", "r7", datetime(2026, 1, 7)).count() == 200


def test_a_merge_follows_the_columns_and_a_failure_leaves_the_table(spark, rows):
    warehouse = Warehouse(spark, "merged_columns", slices=4)
    warehouse.merge("t", fact_rows(spark, n=20), "k", "r1", datetime(2026, 1, 1))
    batch = spark.createDataFrame([("0003", 3, 1.5), ("9999", 1, None)], "k string, v long, extra double")
    merged = warehouse.merge("t", batch, "k", "r2", datetime(2026, 1, 2))
    assert merged.columns == ["k", "v", "extra"] and merged.count() == 21
    assert [tuple(r) for r in merged.filter("extra IS NOT NULL OR k = '9999'").orderBy("k").collect()] == [
        ("0003", 3, 1.5), ("9999", 1, None),
    ]
    before = rows(merged)
    with pytest.raises(Exception, match="has no k"):
        warehouse.merge("t", batch.withColumn("k", F.lit(None).cast("string")), "k", "r3", datetime(2026, 1, 3))
    broken = failing(spark).selectExpr("string(id) AS k", "id AS v", "1.0D AS extra")
    with pytest.raises(Exception, match="stop"):
        warehouse.merge("t", broken, "k", "r3", datetime(2026, 1, 3))
    assert rows(warehouse.read("t")) == before


def test_an_appended_release_may_bring_and_lose_columns(spark, rows):
    warehouse = Warehouse(spark, "appended_columns")

    def add(run, day, select):
        stamped = spark.range(1).selectExpr(*select, f"date '2026-01-0{day}' AS _source_reference_date", f"'{run}' AS _pipeline_run_id")
        return warehouse.append("t", stamped, run, datetime(2026, 1, day), f"2026-01-0{day}")

    add("r1", 1, ["'a' AS a", "'b' AS b"])
    out = add("r2", 2, ["'a2' AS a", "'c' AS c"])
    assert {(r.a, r.b, r.c) for r in out.collect()} == {("a", "b", None), ("a2", None, "c")}
    assert warehouse.release_as_of("t", "2026-01-01") == "2026-01-01"
    assert warehouse.release_as_of("t", "2027-01-01") == "2026-01-02"
    with pytest.raises(ValueError, match="no release"):
        warehouse.release_as_of("t", "2025-12-31")


def test_a_release_of_the_fact_is_one_partition(spark, archives):
    warehouse = Warehouse(spark, "released")
    for release, run in ((1, FIRST), (2, SECOND)):
        run_pipeline(warehouse, declared(archives, release), run, raise_on_failure=False)
    from rollbook.plans.serving import active_by_state_and_activity

    fact = warehouse.read("fct_active_companies_by_release")
    asked = active_by_state_and_activity(fact, "SP", "2026-05-10")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_source_reference_date" in plan.split("PartitionFilters")[1]
    files = fact.filter("_source_reference_date = date '2026-05-10'").inputFiles()
    assert files and all("_source_reference_date=2026-05-10" in f for f in files)


def test_a_corrected_release_replaces_the_first_for_keyed_and_keyless_sources(spark, tmp_path):
    warehouse = Warehouse(spark, "corrected")
    for name, width in (("companies", 7), ("simples", 7)):
        for run, keys in (("r1", (1, 2)), ("r2", (1,))):
            folder = tmp_path / f"{name}-{run}"
            lines = [",".join([str(k), *["x"] * (width - 1)]) for k in keys]
            spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(folder))
            source = register_source(name, str(folder), "append_only", "csv")
            source = Source(**{**source.__dict__, "options": {**source.options, "delimiter": ","}})
            day = 10 if run == "r1" else 11
            ingest(warehouse, source, Run(run, datetime(2026, 5, day), "2026-05-10"))
        assert [r[0] for r in current_raw(warehouse, source).collect()] == ["1"]


def test_upsert_compares_keys_as_staging_writes_them(spark, rows):
    from rollbook.functions.standardize import standardize_code
    from rollbook.operators.upsert import one_per_key, upsert, with_known_keys

    target = spark.createDataFrame([("1", "old"), (None, "old null"), ("2", "stays")], "k string, v string")
    batch = spark.createDataFrame([("00000001", "new"), (" 1", "other"), (None, "n1"), (None, "n2")], "k string, v string")
    forms = {"k": standardize_code("k", 8)}
    merged = upsert(with_known_keys(target, ["k"], forms), one_per_key(batch, ["k"], forms), ["k"], forms)
    assert rows(merged) == sorted([(" 1", "other"), (None, "n1"), (None, "n2"), ("2", "stays")], key=repr)


def test_bytes_by_release_are_those_of_the_files(spark, tmp_path):
    from rollbook.operators import layout

    batch = spark.range(1000).selectExpr("id", "date_add(date '2026-01-01', int(id % 3)) AS _source_reference_date")
    layout.write_release(batch, f"{tmp_path}/t")
    expected = {}
    for folder in (tmp_path / "t").glob("_source_reference_date=*"):
        sizes = [f.stat().st_size for f in folder.glob("*.parquet")]
        expected[folder.name.split("=")[1]] = (len(sizes), sum(sizes))
    measured = layout.bytes_by_partition(spark, f"{tmp_path}/t").collect()
    assert {str(r[0]): (r["files"], r["bytes"]) for r in measured} == expected and len(expected) == 3


def test_a_filter_on_any_column_of_the_curve_skips_files(spark, rows, tmp_path):
    import pyarrow.parquet as pq

    from rollbook.operators.layout import clustered

    table = spark.range(40_000).selectExpr(
        "string(pmod(hash(id), 97)) AS a", "pmod(hash(id, 1), 1000) AS b", "lpad(string(pmod(hash(id, 2), 5000)), 4, '0') AS c"
    ).withColumn("a", F.when(F.col("b") % 50 != 0, F.col("a")))

    def share_read(frame, name, wanted):
        """Of the files, those whose statistics do not rule the value out."""
        frame.write.parquet(f"{tmp_path}/{name}")
        files = [pq.ParquetFile(f).metadata for f in (tmp_path / name).glob("*.parquet")]
        hit = 0
        for meta in files:
            groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
            at = next(i for i in range(3) if groups[0].column(i).path_in_schema == "c")
            hit += any(g.column(at).statistics.min <= wanted <= g.column(at).statistics.max for g in groups)
        return hit / len(files), len(files)

    plain, _ = share_read(clustered(table, ("a", "b", "c"), 64), "plain", "2500")
    curve, files = share_read(clustered(table, ("a", "b", "c"), 64, interleaved=True), "curve", "2500")
    assert files > 30 and plain > 0.9 and curve < 0.6
    assert rows(spark.read.parquet(f"{tmp_path}/curve")) == rows(table)
    empty = clustered(table.limit(0), ("a", "b"), 4, interleaved=True)
    assert empty.count() == 0 and empty.columns == table.columns


def test_archives_hold_what_a_csv_writer_writes(spark):
    values = [("a", 'q"uo;te', None), ("", "line\r\nend", "\x1e\x1f\x1b0"), ("é", "ã, b", '"')]
    for header in (False, True):
        df = spark.createDataFrame(values, "x string, y string, z string").coalesce(1)
        [name] = glob.glob(f"{archived(df, header=header)}/*.zip")
        expected = io.StringIO(newline="")
        csv.writer(expected, delimiter=";", quoting=csv.QUOTE_ALL).writerows([("x", "y", "z")] * header + values)
        with zipfile.ZipFile(name) as archive:
            assert archive.read("table.csv") == expected.getvalue().encode("latin1")


def test_joined_records_are_those_joined_one_by_one():
    plain, inside = ["a", "b", ""], ["a\x1f", "\x1e", "\x1b"]
    for batch in ([plain], [plain, ["x"]], [plain, inside], [plain, []], [[]], [[], ["\x1f"]], [[""]]):
        assert landing._lines(batch, sum(map(len, batch))) == landing.RECORD.join(map(landing._line, batch))


def test_a_second_release_writes_only_the_archives_that_differ(spark):
    register = Register(spark, SMALL)
    first, second = (checked._sources(register, release) for release in range(2))
    assert [a.name for a, b in zip(first, second, strict=True) if a.uri != b.uri] == ["companies"]
