"""Physical layout: release partitions, clustering, and what can be read off them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.plans.schemas import METADATA_COLUMNS

LOADED_AT = METADATA_COLUMNS["loaded_at"]
REFERENCE_DATE = METADATA_COLUMNS["source_reference_date"]
RUN_ID = METADATA_COLUMNS["pipeline_run_id"]

# Clustering columns per table, most selective use first.
CLUSTERING = {
    "raw_companies": ("company_root_cnpj", "legal_nature_code", "company_size_code"),
    "raw_establishments": ("company_root_cnpj", "full_cnpj", "state", "primary_cnae_code"),
    "raw_partners": ("company_root_cnpj", "partner_identifier_code"),
    "raw_simples": ("company_root_cnpj", "simples_option", "mei_option"),
    "dim_companies": ("company_root_cnpj", "company_size_code", "legal_nature_code"),
    "dim_establishments": ("full_cnpj", "company_root_cnpj", "state", "primary_cnae_code"),
    "dim_cnaes": ("cnae_code",),
    "fct_active_companies": ("state", "primary_cnae_code", "company_size_code", "company_root_cnpj"),
    "share_capital": ("company_root_cnpj", "dbt_valid_to"),
}


def with_run_metadata(
    rows: DataFrame,
    loaded_at: datetime,
    source_reference_date: str,
    pipeline_run_id: str,
    names: Mapping[str, str] = METADATA_COLUMNS,
) -> DataFrame:
    """Add the load time, the release date and the run id under the declared names."""
    values: dict[str, Column] = {
        "loaded_at": F.lit(loaded_at.isoformat(" ")).cast("timestamp_ntz"),
        "source_reference_date": F.lit(source_reference_date).cast("date"),
        "pipeline_run_id": F.lit(pipeline_run_id),
    }
    return rows.withColumns({names[k]: v for k, v in values.items() if k in names})


def clustered(
    df: DataFrame,
    columns: Sequence[str],
    partitions: int | None = None,
    interleaved: bool = False,
    sample: int = 10_000,
) -> DataFrame:
    """Range-partition by the clustering columns and sort inside, so block statistics prune.

    Range bounds are drawn over all the columns together, so a value that fills a third of the
    first column spreads over many partitions by the columns after it. Rows equal in all of
    them are spread by the task they come from, which stays the same when a task runs again.

    ``interleaved`` orders by all the columns alike, along a space-filling curve, so that a filter on
    any of them skips files, not only one on the first; it costs the first column some of its own.
    The curve is drawn through ``RANGES`` ranges of each column, whose bounds come from ``sample`` rows:
    they decide where a row lies, never which rows there are.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    count = (partitions,) if partitions else ()
    leading = [place_on_curve(df, present, sample).alias("_place")] if interleaved and len(present) > 1 else []
    order = [*(["_place"] if leading else []), *present]
    return (
        df.select("*", *leading, F.spark_partition_id().alias("_task"))
        .repartitionByRange(*count, *order, "_task")
        .sortWithinPartitions(*order)
        .drop("_task", "_place")
    )


#: Ranges of a column on the curve: four bits.
RANGES = 16


def place_on_curve(df: DataFrame, columns: Sequence[str], sample: int) -> Column:
    """The interleaved bits of the ranges that a row's columns lie in; NULL lies in the first."""
    spread = F.xxhash64(*columns)
    rows = df.select(*columns).orderBy(spread).limit(sample).collect()
    bits = RANGES.bit_length() - 1
    place = F.lit(0).cast("long")
    for at, name in enumerate(columns):
        values = sorted(r[at] for r in rows if r[at] is not None)
        bounds = sorted({values[len(values) * k // RANGES] for k in range(1, RANGES)}) if values else []
        kind = df.schema[name].dataType
        reached = [(F.col(name) >= F.lit(b).cast(kind)).cast("int") for b in bounds]
        number = F.coalesce(sum(reached, F.lit(0)), F.lit(0))
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - at))
    return place


def write_release(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> None:
    """Write the releases in ``df`` under their date; a release written again replaces itself."""
    out = clustered(df, (REFERENCE_DATE, *cluster_by)) if cluster_by else df
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(REFERENCE_DATE)
        .parquet(path)
    )


def of_release(release: str) -> Column:
    """Rows of a release: a literal on the partition column, so one partition is scanned."""
    return F.col(REFERENCE_DATE) == F.lit(release).cast("date")


def read_release(spark: SparkSession, path: str, release: str | None = None) -> DataFrame:
    """Read all releases, or one by partition pruning."""
    rows = spark.read.parquet(path)
    return rows if release is None else rows.filter(of_release(release))


def bytes_by_partition(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and files per release, from the file listing; no file is opened."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    )
    return files.groupBy(REFERENCE_DATE).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def row_counts_by_run(rows: DataFrame, source: str) -> DataFrame:
    return (
        rows.groupBy(REFERENCE_DATE, RUN_ID)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(source).alias("source_name"), REFERENCE_DATE, RUN_ID, "row_count")
    )


def freshness(rows: DataFrame, source: str, as_of: str) -> DataFrame:
    """Latest release of a source and its age in days on ``as_of``."""
    latest = F.max(REFERENCE_DATE)
    return rows.agg(latest.alias("latest_reference_date")).select(
        F.lit(source).alias("source_name"),
        "latest_reference_date",
        F.datediff(F.lit(as_of).cast("date"), F.col("latest_reference_date")).alias("age_days"),
    )


def invalid_and_late(
    rows: DataFrame, parsed: Mapping[str, Column], late_after_days: int
) -> DataFrame:
    """Per release: rows with text that does not parse, and rows loaded too late.

    ``parsed`` maps a text column to its parsed form; filled text whose parsed form is NULL is
    invalid.
    """
    lag = F.datediff(F.col(LOADED_AT).cast("date"), F.col(REFERENCE_DATE))
    return rows.groupBy(REFERENCE_DATE).agg(
        *(
            F.count_if((F.trim(F.col(c)) != "") & p.isNull()).alias(f"invalid_{c}")
            for c, p in parsed.items()
        ),
        F.count_if(lag > late_after_days).alias("late_rows"),
    )
