"""One registered query per operator and model. Each reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.archives import archived, paged
from checks.inputs import AS_OF, RELEASES, RUN_IDS
from checks.register import Register, run_time
from rollbook.functions import labels
from rollbook.functions import standardize as std
from rollbook.operators import history, layout, quality
from rollbook.operators.upsert import current_state, upsert
from rollbook.plans import intermediate, marts, rules, serving
from rollbook.plans.ingest import Run, current_raw, ingest, ingest_all, register_source
from rollbook.plans.pipeline import RELEASED_FACT, SNAPSHOT_COLUMNS, run_pipeline
from rollbook.plans.schemas import FULL, RAW_COLUMNS, ROOT, raw_table
from rollbook.plans.staging import STAGING
from rollbook.plans.warehouse import OutOfOrderError, Warehouse
from rollbook.session import all_written, concurrently, scratch_path, written
from rollbook.sources.formats import read_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Register], DataFrame]) -> Callable[[Register], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Register(spark, sf_dir))
    return build


# Raw tables.


def _raw_query(source: str) -> None:
    QUERIES[f"raw_{source}"] = lambda spark, sf_dir: Register(spark, sf_dir).raw(source)
    QUERIES[f"stg_{source}"] = lambda spark, sf_dir: Register(spark, sf_dir).stg(source)


for _source in RAW_COLUMNS:
    _raw_query(_source)


# Scalar expressions.


@query
def expr_clean_text(r: Register) -> DataFrame:
    return r.given("documents").select(
        "doc_id",
        std.clean_text("text").alias("text"),
        std.clean_text("concat(chr(160), text, '  ')").alias("padded_text"),
        std.clean_text("lang").alias("lang"),
        std.clean_text("n_chars").alias("n_chars"),
    )


@query
def expr_clean_upper_lower(r: Register) -> DataFrame:
    return r.raw("establishments").select(
        "postal_code",
        std.clean_upper("state").alias("state"),
        std.clean_lower("email").alias("email"),
        std.clean_upper("trade_name").alias("upper_name"),
        std.clean_lower("street_name").alias("lower_street"),
    )


@query
def expr_standardize_code(r: Register) -> DataFrame:
    return r.raw("establishments").select(
        "postal_code",
        std.standardize_code("company_root_cnpj", 8).alias("padded_root"),
        std.standardize_code("trade_name", 4).alias("cut_name"),
        std.standardize_code("state", 2).alias("exact_state"),
        std.standardize_code("country_code", 3).alias("country"),
        std.standardize_code("district", 20).alias("padded_district"),
    )


@query
def expr_parse_date(r: Register) -> DataFrame:
    day = "registration_status_date"
    dashed = f"concat_ws('-', substr({day}, 1, 4), substr({day}, 5, 2), substr({day}, 7, 2))"
    texts = {
        "eight_digits": day,
        "no_such_day": "activity_start_date",
        "filler": "special_status_date",
        "seven_digits": f"substr({day}, 1, 7)",
        "six_digits": f"substr({day}, 1, 6)",
        "nine_digits": f"{day} || '1'",
        "tab_before": f"chr(9) || {day} || ' '",
        "dashed": dashed,
        "words": "trade_name",
    }
    return r.raw("establishments").select(
        "postal_code", *(std.parse_compact_date(text).alias(name) for name, text in texts.items())
    )


@query
def expr_yes_no(r: Register) -> DataFrame:
    return r.raw("simples").select(
        ROOT,
        "simples_option_date",
        std.yes_no_to_boolean("simples_option").alias("is_simples"),
        std.yes_no_to_boolean("mei_option").alias("is_mei"),
        std.yes_no_to_boolean("lower(mei_option)").alias("is_mei_lower"),
        std.yes_no_to_boolean("nullif(simples_option, 'N')").alias("is_simples_null"),
    )


@query
def expr_decimal_comma(r: Register) -> DataFrame:
    texts = {
        "amount": "share_capital",
        "negative_rounded": "' -' || share_capital || '5 '",
        "thousands_dot": "'1.' || share_capital",
        "exponent": "share_capital || 'e3'",
        "too_large": "'99999999999999' || share_capital",
        "words": "legal_name",
    }
    return r.raw("companies").select(
        ROOT, *(std.parse_amount(text).alias(name) for name, text in texts.items())
    )


@query
def expr_concat_key(r: Register) -> DataFrame:
    order = "nullif(branch_order, '0')"
    return r.raw("establishments").select(
        "postal_code", std.establishment_key(ROOT, order, "check_digits").alias(FULL)
    )


@query
def expr_code_hierarchy(r: Register) -> DataFrame:
    code, description = F.col("cnae_code"), F.col("cnae_description")
    return r.stg("cnaes").select(
        code,
        *(labels.activity_prefix(code, level).alias(level) for level in labels.ACTIVITY_LEVELS),
        labels.activity_label(code, F.nullif(description, F.lit(""))).alias("label"),
        labels.activity_label(code, F.when(code > "0001000", description)).alias("half_label"),
    )


@query
def expr_capital_range(r: Register) -> DataFrame:
    capital = F.col("share_capital")
    return r.stg("companies").select(
        ROOT,
        labels.capital_range(capital).alias("capital_range"),
        labels.capital_range(-capital).alias("negative_range"),
    )


@query
def expr_code_labels(r: Register) -> DataFrame:
    sizes = r.stg("companies").select(
        F.lit("size").alias("kind"),
        F.col("company_size_code").alias("code"),
        labels.label_of(F.col("company_size_code"), labels.COMPANY_SIZE_LABELS).alias("label"),
    )
    establishments = r.stg("establishments")
    known = {
        "branch": ("branch_type_code", labels.BRANCH_TYPE_LABELS),
        "status": ("registration_status_code", labels.REGISTRATION_STATUS_LABELS),
    }
    for kind, (name, mapping) in known.items():
        sizes = sizes.unionByName(
            establishments.select(
                F.lit(kind).alias("kind"),
                F.col(name).alias("code"),
                labels.label_of(F.col(name), mapping).alias("label"),
            )
        )
    return sizes.groupBy("kind", "code", "label").agg(F.count(F.lit(1)).alias("rows"))


@query
def expr_presence_flags(r: Register) -> DataFrame:
    return r.stg("establishments").select(
        FULL,
        labels.present_flag(F.col("phone_1"), F.col("phone_2")).alias("has_phone"),
        labels.present_flag(F.col("email")).alias("has_email"),
    )


@query
def expr_equality_flags(r: Register) -> DataFrame:
    branch_type = F.nullif("branch_type_code", F.lit("2"))
    return r.stg("establishments").select(
        FULL,
        labels.equals_flag(branch_type, labels.HEADQUARTERS).alias("is_headquarters"),
        labels.equals_flag(branch_type, labels.BRANCH).alias("is_branch"),
        labels.equals_flag(F.col("registration_status_code"), labels.ACTIVE).alias("is_active"),
    )


@query
def expr_defaults_and_constants(r: Register) -> DataFrame:
    return r.profile.select(
        ROOT,
        labels.zero_if_null(F.col("share_capital")).alias("share_capital_amount"),
        F.lit(1).alias("active_company_count"),
        labels.false_last(F.col("is_mei")).alias("mei_sort_key"),
        (F.col("company_size_code") != "01").alias("not_micro"),
    )


# Filters.


@query
def filter_null_keys(r: Register) -> DataFrame:
    """Only rows whose standardized key is known survive staging."""
    raw = r.raw("simples").withColumn(ROOT, F.nullif("simples_option", F.lit("N")))
    return STAGING["simples"](raw)


@query
def filter_active(r: Register) -> DataFrame:
    return r.activity.filter("is_active").select(FULL, ROOT, "registration_status_code", "state")


# Joins.


@query
def join_left_rollup(r: Register) -> DataFrame:
    rollup = intermediate.simples_by_company(r.stg("simples"))
    return r.stg("companies").join(rollup, ROOT, "left")


@query
def join_left_chain(r: Register) -> DataFrame:
    profile, partners = r.company_tables
    return (
        r.activity.select(FULL, ROOT, "state")
        .join(profile.select(ROOT, "legal_name", "is_simples"), ROOT, "left")
        .join(partners, ROOT, "left")
    )


@query
def join_left_small_dimension(r: Register) -> DataFrame:
    cnaes = r.cnaes.select(F.col("cnae_code").alias("primary_cnae_code"), "cnae_subclass_label")
    return r.activity.select(FULL, "primary_cnae_code").join(cnaes, "primary_cnae_code", "left")


@query
def join_left_residual(r: Register) -> DataFrame:
    """Every active company, with its representative where the rank is one."""
    companies = r.base.groupBy(ROOT).agg(F.count(F.lit(1)).alias("rows"))
    best = marts.representative_establishments(r.base)
    return companies.join(best.select(ROOT, FULL, "establishment_rank"), ROOT, "left")


@query
def join_anti_orphans(r: Register) -> DataFrame:
    return quality.orphan_values(r.activity, "primary_cnae_code", r.stg("cnaes"), "cnae_code")


# Aggregations.


@query
def agg_conditional_sum(r: Register) -> DataFrame:
    return r.partners.select(ROOT, *intermediate.PARTNER_COUNTS)


@query
def agg_min_max(r: Register) -> DataFrame:
    return r.stg("establishments").groupBy(ROOT).agg(
        F.min("activity_start_date").alias("first_activity_start_date"),
        F.max("registration_status_date").alias("latest_registration_status_date"),
        F.max("trade_name").alias("last_name"),
    )


@query
def agg_distinct(r: Register) -> DataFrame:
    return marts.distinct_counts(r.base)


@query
def agg_bool_or(r: Register) -> DataFrame:
    return r.base.groupBy(ROOT).agg(
        labels.any_true(F.col("is_simples")).alias("is_simples"),
        labels.any_true(F.col("is_mei")).alias("is_mei"),
        (F.max(F.when(F.col("is_headquarters"), 1).otherwise(0)) == 1).alias("has_headquarters"),
    )


@query
def agg_max_default(r: Register) -> DataFrame:
    return r.base.groupBy(ROOT).agg(
        F.max(labels.zero_if_null(F.col("share_capital"))).alias("share_capital_amount"),
        F.max("legal_name").alias("legal_name"),
        F.max(labels.zero_if_null(F.col("partner_count"))).alias("partner_count"),
    )


# Window.


@query
def window_representative(r: Register) -> DataFrame:
    return marts.representative_establishments(r.base)


# Intermediate models and marts.


@query
def int_company_profile(r: Register) -> DataFrame:
    return r.profile


@query
def int_establishment_activity(r: Register) -> DataFrame:
    return r.activity


@query
def int_partner_metrics(r: Register) -> DataFrame:
    return r.partners


@query
def int_active_company_base(r: Register) -> DataFrame:
    return r.base


@query
def dim_cnaes(r: Register) -> DataFrame:
    return r.cnaes


@query
def dim_companies(r: Register) -> DataFrame:
    return r.companies


@query
def dim_establishments(r: Register) -> DataFrame:
    return r.establishments


@query
def fct_active_companies(r: Register) -> DataFrame:
    return r.fact


@query
def fct_active_companies_from_base(r: Register) -> DataFrame:
    return marts.fct_active_companies(r.base)


# Incremental loads.


@query
def incremental_first_batch(r: Register) -> DataFrame:
    return upsert(None, r.fact, [ROOT])


def _two_facts(r: Register) -> tuple[DataFrame, DataFrame]:
    """Target and batch as the job has them: written, because an upsert reads its batch twice."""
    facts = all_written({"fact": r.fact, "fact_batch": r.second_fact})
    return facts["fact"], facts["fact_batch"]


@query
def incremental_second_batch(r: Register) -> DataFrame:
    """Both batches merged into the published fact, slice by slice."""
    warehouse = _warehouse(r)
    for release, batch in enumerate(_two_facts(r)):
        merged = warehouse.merge("fact", batch, ROOT, RUN_IDS[release], run_time(release))
    return merged


@query
def incremental_one_changed_company(r: Register) -> DataFrame:
    """A later run in which one company changed: the slices it writes, and the rows that result."""
    warehouse = _warehouse(r)
    fact = written(r.fact, "fact")
    warehouse.merge("fact", fact, ROOT, RUN_IDS[0], run_time(0))
    before = set(warehouse.read("fact").inputFiles())
    lowest = fact.agg(F.min(ROOT)).first()[0]
    name = F.when(F.col(ROOT) == lowest, F.lit("changed")).otherwise(F.col("legal_name"))
    batch = written(fact.withColumn("legal_name", name), "fact")
    merged = warehouse.merge("fact", batch, ROOT, RUN_IDS[1], run_time(1))
    new_files = len(set(merged.inputFiles()) - before)
    return merged.select(ROOT, "legal_name", F.lit(new_files).alias("new_files"))


@query
def incremental_schema_sync(r: Register) -> DataFrame:
    target, batch = _two_facts(r)
    reference_date = F.lit(RELEASES[1]).cast("date")
    batch = batch.drop("municipality_code").withColumn("source_reference_date", reference_date)
    return upsert(target, batch, [ROOT])


# History.

CAPITAL = (ROOT, ("share_capital",))


def _versions(r: Register, releases: int) -> DataFrame:
    """The history after some releases; each is written before the next one reads it."""
    versions = history.first_versions(r.capital_source(0), ROOT, run_time(0))
    for release in range(1, releases):
        stored = written(versions, "versions")
        versions = history.advance(stored, r.capital_source(release), *CAPITAL, run_time(release))
    return versions


@query
def scd2_initial(r: Register) -> DataFrame:
    return _versions(r, 1)


@query
def scd2_second_release(r: Register) -> DataFrame:
    return _versions(r, 2)


@query
def scd2_reappear(r: Register) -> DataFrame:
    return _versions(r, 3)


@query
def scd2_history_lookup(r: Register) -> DataFrame:
    return serving.share_capital_history(_versions(r, 3), "00000130")


# Data quality.


@query
def dq_not_null(r: Register) -> DataFrame:
    return quality.null_rows(r.companies, "share_capital").select(ROOT, "legal_name")


@query
def dq_unique(r: Register) -> DataFrame:
    """The company key repeats among the tax-regime records."""
    return quality.repeated_values(r.stg("simples"), ROOT)


@query
def dq_accepted_values(r: Register) -> DataFrame:
    return quality.unaccepted_values(
        r.stg("establishments"), "registration_status_code", rules.STATUSES
    )


@query
def dq_relationships(r: Register) -> DataFrame:
    return quality.orphan_values(r.fact, "primary_cnae_code", r.cnaes, "cnae_code")


@query
def dq_business_rule(r: Register) -> DataFrame:
    """Broken on purpose: companies of one state report a partner too many, or negative capital."""
    fact = r.fact.withColumns(
        {
            "partner_count": F.col("partner_count") + F.when(F.col("state") == "SP", 1).otherwise(0),
            "share_capital_amount": F.when(F.col("state") == "RJ", -F.col("share_capital_amount"))
            .otherwise(F.col("share_capital_amount"))
            .cast("decimal(18,2)"),
        }
    )
    return rules.inconsistent_active_companies(fact)


@query
def dq_suite(r: Register) -> DataFrame:
    """Every declared rule over every table; tables are written once and then checked."""
    tables = all_written({f"stg_{source}": r.stg(source) for source in RAW_COLUMNS})
    activity = intermediate.establishment_activity(tables["stg_establishments"])
    cnaes = marts.dim_cnaes(tables["stg_cnaes"])
    profile = intermediate.company_profile(tables["stg_companies"], tables["stg_simples"])
    partners = intermediate.partner_metrics(tables["stg_partners"])
    tables |= all_written({"company_profile": profile, "partner_metrics": partners})
    profile, partners = tables["company_profile"], tables["partner_metrics"]
    tables |= all_written(
        {
            "dim_establishments": marts.dim_establishments(activity, cnaes),
            "active_company_base": intermediate.active_company_base(activity, profile, partners),
            "fct_active_companies": marts.fct_active_companies_from_parts(activity, profile, partners),
        }
    )
    tables |= {
        "establishment_activity": activity,
        "dim_cnaes": cnaes,
        "dim_companies": marts.dim_companies(profile),
        "share_capital_snapshot": history.first_versions(profile.select(*SNAPSHOT_COLUMNS), ROOT, run_time(0)),
    }
    return rules.run_checks(tables)


# Serving.


@query
def serve_active_by_state_activity(r: Register) -> DataFrame:
    return serving.active_by_state_and_activity(r.fact)


@query
def serve_active_in_state_release(r: Register) -> DataFrame:
    """Of a fact published for two releases, the first one's companies in a state."""
    return serving.active_by_state_and_activity(_released_facts(r).read(RELEASED_FACT), "SP", RELEASES[0])


@query
def serve_active_as_of(r: Register) -> DataFrame:
    """The newest release on or before a day."""
    warehouse = _released_facts(r)
    release = warehouse.release_as_of(RELEASED_FACT, AS_OF)
    return serving.active_by_state_and_activity(warehouse.read(RELEASED_FACT), release=release)


def _released_facts(r: Register) -> Warehouse:
    warehouse = _warehouse(r)
    for release, fact in enumerate((r.fact, r.second_fact)):
        run = _run(release)
        stamped = layout.with_run_metadata(fact, run.run_time, run.source_reference_date, run.run_id)
        warehouse.append(RELEASED_FACT, stamped, run.run_id, run.run_time, run.source_reference_date)
    return warehouse


@query
def serve_company_lookup(r: Register) -> DataFrame:
    return serving.company_lookup(r.companies, "00000042")


@query
def serve_row_counts(r: Register) -> DataFrame:
    tables = {f"raw_{source}": r.raw(source) for source in RAW_COLUMNS}
    return serving.row_counts(tables | {"fct_active_companies": r.fact})


@query
def serve_preview(r: Register) -> DataFrame:
    """A preview of the first companies by key."""
    return serving.preview(r.companies.orderBy(ROOT))


# Raw loads and layout.


def _releases(r: Register) -> str:
    """Two releases of the companies, each written as its own partition."""
    path = scratch_path(r.spark, "raw_companies")
    for release in (0, 1):
        layout.write_release(
            r.stamped_companies(release), path, layout.CLUSTERING["raw_companies"]
        )
    return path


@query
def raw_append_only(r: Register) -> DataFrame:
    path = _releases(r)
    # The second release once more: a repeated run replaces itself.
    layout.write_release(r.stamped_companies(1), path)
    return layout.read_release(r.spark, path)


@query
def raw_upsert(r: Register) -> DataFrame:
    return upsert(r.raw_companies(0), r.raw_companies(1), [ROOT])


@query
def raw_metadata(r: Register) -> DataFrame:
    return r.stamped_companies(0)


@query
def dedupe_current_state(r: Register) -> DataFrame:
    stored = r.stamped_companies(0).unionByName(r.stamped_companies(1))
    return current_state(stored, [ROOT], [layout.REFERENCE_DATE, layout.LOADED_AT, layout.RUN_ID])


@query
def partition_pruned(r: Register) -> DataFrame:
    return layout.read_release(r.spark, _releases(r), RELEASES[1]).select(
        ROOT, "share_capital", layout.REFERENCE_DATE
    )


@query
def layout_clustered(r: Register) -> DataFrame:
    return layout.clustered(r.fact, layout.CLUSTERING["fct_active_companies"])


@query
def layout_interleaved(r: Register) -> DataFrame:
    """Every clustering column alike decides where a row lies; no row changes."""
    return layout.clustered(written(r.fact, "fact"), layout.CLUSTERING["fct_active_companies"], 8, interleaved=True)


@query
def layout_bytes_by_release(r: Register) -> DataFrame:
    """Files and bytes of each release; they depend on the tasks that wrote them, so a test compares
    them with the folder instead of SQL."""
    return layout.bytes_by_partition(r.spark, _releases(r))


def _stored(r: Register) -> DataFrame:
    return r.stamped_companies(0).unionByName(r.stamped_companies(1))


@query
def row_counts_by_run(r: Register) -> DataFrame:
    return layout.row_counts_by_run(_stored(r), "companies")


@query
def freshness_by_source(r: Register) -> DataFrame:
    return layout.freshness(_stored(r), "companies", AS_OF)


@query
def invalid_and_late_records(r: Register) -> DataFrame:
    parsed = {"share_capital": std.parse_amount("share_capital")}
    return layout.invalid_and_late(_stored(r), parsed, late_after_days=7)


# Ingest.

_DELIMITED = {"delimiter": ";", "encoding": "latin1", "has_header": False}


def _read_archives(
    r: Register, source: str, archives: int | None = None, row_limit: int | None = None
) -> DataFrame:
    path = archived(r.raw(source), archives)
    options = {**_DELIMITED, "columns": RAW_COLUMNS[source]}
    return read_source(r.spark, "zip_csv", f"{path}/*.zip", options, row_limit)


@query
def ingest_zip_csv(r: Register) -> DataFrame:
    """All activity codes through archives, one per task that writes them."""
    return _read_archives(r, "cnaes")


@query
def ingest_multi_archive(r: Register) -> DataFrame:
    """All establishments through eight archives or more."""
    return _read_archives(r, "establishments", 8)


@query
def ingest_row_limit(r: Register) -> DataFrame:
    """The declared sample: the first hundred rows of all archives together, in their order."""
    key = F.col(ROOT).cast("long")
    ordered = r.raw("companies").repartitionByRange(4, key).sortWithinPartitions(key)
    options = {**_DELIMITED, "columns": RAW_COLUMNS["companies"]}
    return read_source(r.spark, "zip_csv", f"{archived(ordered)}/*.zip", options, 100)


@query
def zip_member_choice(r: Register) -> DataFrame:
    """The first member named .csv, in any case, is the table; without one the first file is."""
    named = archived(r.raw("cnaes"), member="TABLE.CSV", others={"readme.txt": "not;this\n"})
    unnamed = archived(r.raw("cnaes"), member="K3241.CNAECSV", others={"folder/": ""})
    options = {**_DELIMITED, "columns": RAW_COLUMNS["cnaes"]}
    first, second = (read_source(r.spark, "zip_csv", f"{path}/*.zip", options) for path in (named, unnamed))
    return first.withColumn("archive", F.lit("named")).unionByName(second.withColumn("archive", F.lit("unnamed")))


@query
def zip_header(r: Register) -> DataFrame:
    """Archives whose headers differ: other orders, columns that only some have."""
    raw, odd = r.raw("companies"), F.col(ROOT).cast("long") % 2 == 1
    reordered = raw.filter(odd).select(*reversed(raw.columns))
    fewer = raw.filter(~odd).select("share_capital", ROOT, "legal_name", F.lit("even").alias("note"))
    address = [f"{archived(df, 2, header=True)}/*.zip" for df in (reordered, fewer)]
    return read_source(r.spark, "zip_csv", address, {"delimiter": ";", "encoding": "latin1"})


def _ragged(r: Register) -> str:
    """Companies as records of seven, four and nine fields."""
    fields = F.array(*RAW_COLUMNS["companies"])
    rest = F.col(ROOT).cast("long") % 3
    longer = F.concat(fields, F.array(F.lit("more"), F.lit("")))
    return archived(
        r.raw("companies").select(
            F.when(rest == 0, F.slice(fields, 1, 4)).when(rest == 1, longer).otherwise(fields).alias("fields")
        ),
        3,
    )


@query
def zip_row_width(r: Register) -> DataFrame:
    """Short records are filled with NULL, long ones cut."""
    options = {**_DELIMITED, "columns": RAW_COLUMNS["companies"]}
    return read_source(r.spark, "zip_csv", f"{_ragged(r)}/*.zip", options)


@query
def zip_rejected_records(r: Register) -> DataFrame:
    """With a quarantine the job keeps records of a wrong width apart from the raw table."""
    warehouse = _warehouse(r)
    declared = register_source("companies", f"{_ragged(r)}/*.zip")
    source = replace(declared, options={**declared.options, "quarantine": True})
    result = ingest(warehouse, source, _run(0))
    kept = warehouse.read(source.target_table).select(F.lit("row").alias("kind"), F.col(ROOT).alias("content"))
    record = F.from_json("record", "array<string>")
    rejected = warehouse.read(f"{source.target_table}__rejected").select(
        F.lit("rejected").alias("kind"), F.concat_ws("|", record).alias("content")
    )
    counts = [("rows", result["row_count"]), ("rejects", result["rejected_count"])]
    counted = r.spark.createDataFrame([(k, str(n)) for k, n in counts], "kind string, content string")
    return kept.unionByName(rejected).unionByName(counted)


@query
def ingest_csv(r: Register) -> DataFrame:
    path = scratch_path(r.spark, "partners-csv")
    r.raw("partners").write.options(sep=";", encoding="ISO-8859-1", escape='"').csv(path)
    options = {**_DELIMITED, "columns": RAW_COLUMNS["partners"]}
    raw = read_source(r.spark, "csv", path, options)
    return STAGING["partners"](raw)


@query
def ingest_json(r: Register) -> DataFrame:
    path = scratch_path(r.spark, "simples-json")
    r.raw("simples").write.json(path)
    return read_source(r.spark, "json", path, {"columns": RAW_COLUMNS["simples"]})


@query
def ingest_json_pages(r: Register) -> DataFrame:
    """The companies through pages of an API, one input file and task each."""
    address, last = paged(r.raw("companies"), ROOT, 500)
    options = {"columns": RAW_COLUMNS["companies"], "records_path": "items", "first_page": 0, "last_page": last}
    return read_source(r.spark, "json_pages", address, options)


# The job and its writes, through published tables.


def _warehouse(r: Register, **settings) -> Warehouse:
    """A database of its own in the shared folder."""
    name = f"checks_{uuid.uuid4().hex}"
    r.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(r.spark, name)}'")
    return Warehouse(r.spark, name, **settings)


def _advanced(r: Register, warehouse: Warehouse, release: int, source: int | None = None) -> DataFrame:
    """The stored history after a release, computed from its own file or from that of another."""
    rows = r.capital_source(release if source is None else source)
    return warehouse.advance_history("capital", rows, *CAPITAL, RUN_IDS[release], run_time(release))


@query
def history_repeated_run(r: Register) -> DataFrame:
    """The second release is loaded from a wrong file and then again from its own."""
    warehouse = _warehouse(r)
    _advanced(r, warehouse, 0)
    _advanced(r, warehouse, 1, source=2)
    return _advanced(r, warehouse, 1)


@query
def history_repeated_older_run(r: Register) -> DataFrame:
    """The second release is refused once the third is there."""
    warehouse = _warehouse(r)
    for release in range(3):
        _advanced(r, warehouse, release)
    try:
        _advanced(r, warehouse, 1)
    except OutOfOrderError:
        return warehouse.read("capital")
    raise AssertionError("an older run was repeated")


@query
def publish_failed_repeat(r: Register) -> DataFrame:
    """A repeat that fails while it writes leaves the table."""
    warehouse = _warehouse(r)
    warehouse.publish("companies", r.raw_companies(0), RUN_IDS[0])
    stops = F.when(F.col(ROOT).isNotNull(), F.raise_error(F.lit("stop")).cast("string"))
    try:
        warehouse.publish("companies", r.raw_companies(1).withColumn(ROOT, stops), RUN_IDS[0])
    except PySparkException:
        return warehouse.read("companies")
    raise AssertionError("the repeat did not fail")


@query
def append_empty_repeat(r: Register) -> DataFrame:
    """The second release is loaded and then repeated from a file without rows."""
    warehouse = _warehouse(r)
    for release, rows in (
        (0, r.stamped_companies(0)),
        (1, r.stamped_companies(1)),
        (1, r.stamped_companies(1).filter("false")),
    ):
        warehouse.append("companies", rows, RUN_IDS[release], run_time(release), RELEASES[release])
    return warehouse.read("companies")


@query
def ingest_malformed_json(r: Register) -> DataFrame:
    """Records that are no JSON are kept apart and counted, and are no rows."""
    path = scratch_path(r.spark, "companies-json")
    broken = F.col(ROOT).cast("long") % 50 == 0
    record = F.to_json(F.struct(*RAW_COLUMNS["companies"]))
    lines = r.raw("companies").select(F.when(broken, F.concat(F.lit("{broken "), ROOT)).otherwise(record).alias("value"))
    lines.write.text(path)
    warehouse = _warehouse(r)
    source = replace(register_source("companies", path, source_format="json"), strategy="append_only")
    result = ingest(warehouse, source, _run(0))
    rejected = warehouse.read(f"{source.target_table}__rejected")
    counted = [("rows", str(result["row_count"])), ("rejects", str(result["rejected_count"]))]
    return (
        warehouse.read(source.target_table)
        .select(F.lit("row").alias("kind"), F.col(ROOT).alias("content"))
        .unionByName(rejected.select(F.lit("rejected").alias("kind"), F.col("record").alias("content")))
        .unionByName(r.spark.createDataFrame(counted, "kind string, content string"))
    )


def _run(release: int) -> Run:
    return Run(RUN_IDS[release], run_time(release), RELEASES[release])


def _ingested(r: Register, strategy: str, warehouse: Warehouse) -> list[DataFrame]:
    """Two releases of the companies through archives; the raw table and its current rows."""
    for release in range(2):
        path = archived(r.raw_companies(release), 4)
        source = register_source("companies", f"{path}/*.zip", strategy)
        ingest(warehouse, source, _run(release))
    return [warehouse.read(raw_table("companies")), current_raw(warehouse, source)]


@query
def ingest_overwrite(r: Register) -> DataFrame:
    return _ingested(r, "overwrite", _warehouse(r))[0]


@query
def ingest_append(r: Register) -> DataFrame:
    return _ingested(r, "append_only", _warehouse(r))[0].drop(layout.LOADED_AT)


@query
def ingest_upsert(r: Register) -> DataFrame:
    return _ingested(r, "upsert", _warehouse(r))[0]


@query
def current_state_two_releases(r: Register) -> DataFrame:
    """Of an appended table the newest release counts: what is gone from it is gone."""
    return _ingested(r, "append_only", _warehouse(r))[1]


def _sources(r: Register, release: int = 0) -> list:
    """The five sources of a release. Only the companies differ, so other archives are written once."""
    wanted = {s: (s, release if s == "companies" else 0) for s in RAW_COLUMNS}
    raw = {key: r.raw_companies(release) if s == "companies" else r.raw(s) for s, key in wanted.items()}
    new = {key: lambda df=df: archived(df, 2) for key, df in raw.items() if key not in r.archives}
    if new:
        r.archives.update(concurrently(new))
    return [register_source(s, f"{r.archives[key]}/*.zip") for s, key in wanted.items()]


@query
def ingest_job(r: Register) -> DataFrame:
    """The result rows of a run that ingests every source."""
    results = ingest_all(_warehouse(r), _sources(r), _run(0))
    columns = "source_name string, target_table string, load_strategy string, row_count long"
    names = ("source_name", "target_table", "load_strategy", "row_count")
    return r.spark.createDataFrame([tuple(x[n] for n in names) for x in results], columns)


@query
def pipeline_fact(r: Register) -> DataFrame:
    warehouse = _warehouse(r)
    run_pipeline(warehouse, _sources(r), _run(0), raise_on_failure=False)
    return warehouse.read("fct_active_companies")


@query
def pipeline_snapshot_two_releases(r: Register) -> DataFrame:
    warehouse = _warehouse(r)
    for release in range(2):
        run_pipeline(warehouse, _sources(r, release), _run(release), raise_on_failure=False)
    return warehouse.read("snap_company_registry__share_capital")


@query
def pipeline_checks(r: Register) -> DataFrame:
    """The summary the job publishes, over the tables it built."""
    warehouse = _warehouse(r)
    run_pipeline(warehouse, _sources(r), _run(0), raise_on_failure=False)
    return warehouse.read("data_quality_checks")


@query
def pipeline_released_fact(r: Register) -> DataFrame:
    """The job's own fact by release: what it published for the second of two runs."""
    warehouse = _warehouse(r)
    for release in range(2):
        run_pipeline(warehouse, _sources(r, release), _run(release), raise_on_failure=False)
    fact = warehouse.read(RELEASED_FACT).filter(layout.of_release(RELEASES[1]))
    return fact.select(*marts.FACT_COLUMNS, layout.REFERENCE_DATE)
