"""Named source formats: a declared key selects the reader.

A reader gives the rows, every column text, and what it could not take as a row. Malformed records
are no rows: they are counted in the pass that reads the rows and kept apart with their file.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rollbook.plans.schemas import text_schema
from rollbook.sources.landing import (
    PART_BYTES,
    Landing,
    TextFormat,
    drop_folder,
    is_http,
    land,
    land_files,
    matching_files,
)

Options = Mapping[str, Any]
Address = str | Sequence[str]

# Charset names of declarations that Spark's text readers know by another name.
CHARSETS = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1"}

CORRUPT = "_corrupt_record"
REJECTED = StructType([StructField("source_file", StringType()), StructField("record", StringType())])


@dataclass
class Opened:
    """A source that is read: its rows, its malformed records, and what to remove after use.

    ``malformed`` counts the malformed records; where reading itself counts them, it waits until
    the rows were read. ``landing`` is there for archives.
    """

    rows: DataFrame
    rejected: DataFrame | None = None
    malformed: Callable[[], int] = lambda: 0
    folders: list[str] = field(default_factory=list)
    landing: Landing | None = None

    def close(self) -> None:
        for folder in self.folders:
            drop_folder(folder)


Reader = Callable[[SparkSession, Address, Options, int | None], Opened]


def _declared_columns(options: Options) -> Sequence[str]:
    """Declared columns, or none when a header line names them."""
    if options.get("has_header", True):
        return ()
    columns = options.get("columns") or ()
    if not columns:
        raise ValueError("a source without a header needs its columns declared")
    return columns


def read_zip_csv(spark: SparkSession, uri: Address, options: Options, row_limit: int | None) -> Opened:
    """Delimited text inside zip archives, landed by one task per archive; see ``landing``.

    Records of a wrong width are filled or cut; with ``quarantine`` they are malformed instead.
    """
    columns = _declared_columns(options)
    text = TextFormat(options.get("delimiter", ","), options.get("encoding", "utf-8"), not columns)
    landing = land(spark, uri, text, columns, row_limit, int(options.get("part_bytes", PART_BYTES)))
    strict = bool(options.get("quarantine", False))
    rejected = landing.odd_rows().select("source_file", F.to_json(F.col("fields")).alias("record")) if strict else None
    odd = sum(a.odd_records for a in landing.archives) if strict else 0
    return Opened(landing.rows(strict), rejected, lambda: odd, [landing.folder], landing)


def _reachable(spark: SparkSession, uri: Address, suffix: str) -> tuple[list[str], list[str]]:
    """Files Spark can read, and the folders made for them: HTTP addresses are landed first."""
    if isinstance(uri, str) and not is_http(uri):
        return [uri], []
    uris = matching_files(uri)
    remote = [u for u in uris if is_http(u)]
    if not remote:
        return uris, []
    folder, files = land_files(spark, remote, suffix)
    return [*(u for u in uris if not is_http(u)), *files], [folder]


def read_csv(spark: SparkSession, uri: Address, options: Options, row_limit: int | None) -> Opened:
    """Plain delimited text, one or many files, every column text.

    Quoted line ends are off by default because they keep a file in one task; declare
    ``multi_line`` for files that hold them.
    """
    columns = _declared_columns(options)
    charset = options.get("encoding", "utf-8")
    files, folders = _reachable(spark, uri, ".csv")
    reader = spark.read.options(
        sep=options.get("delimiter", ","),
        encoding=CHARSETS.get(charset, charset),
        header=not columns,
        escape='"',
        multiLine=options.get("multi_line", False),
        mode="PERMISSIVE",
        inferSchema=False,
    )
    return Opened((reader.schema(text_schema(columns)) if columns else reader).csv(files), folders=folders)


def read_json(spark: SparkSession, uri: Address, options: Options, row_limit: int | None) -> Opened:
    """JSON records, one per line, or whole documents with ``multi_line``; every column text.

    ``records_path`` names the array that holds the records of an API response. A record, or a
    document, that is no such JSON is malformed.
    """
    columns = options.get("columns") or ()
    if not columns:
        raise ValueError("a json source needs its columns declared")
    records_path = options.get("records_path")
    record = text_schema(columns).simpleString()
    schema = f"{records_path} array<{record}>" if records_path else ", ".join(f"`{c}` string" for c in columns)
    files, folders = _reachable(spark, uri, ".json")
    parsed = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", options.get("multi_line", False))
        .json(files)
    )
    # Spark reads the corrupt column only beside another one, also where rows are just counted.
    first = F.col(records_path or columns[0]).cast("string")
    seen = F.length(F.coalesce(first, F.lit(""))) >= 0
    counted = Observation()
    observed = parsed.observe(counted, F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"))
    rows = observed.filter(F.col(CORRUPT).isNull() & seen)
    rows = rows.select(F.inline(records_path)) if records_path else rows.select(*columns)
    rejected = parsed.filter(F.col(CORRUPT).isNotNull() & seen).select(
        F.col("_metadata.file_path").alias("source_file"), F.col(CORRUPT).alias("record")
    )
    return Opened(rows, rejected, lambda: counted.get["malformed"], folders)


def read_json_pages(spark: SparkSession, uri: Address, options: Options, row_limit: int | None) -> Opened:
    """The pages of a JSON API: the address holds ``{page}``, from ``first_page`` (1) to ``last_page``.

    Every page is a file of its own, fetched by a task of its own, with retries, where it comes over HTTP.
    """
    if not isinstance(uri, str) or "{page}" not in uri:
        raise ValueError("a paged source needs {page} in its address")
    first, last = int(options.get("first_page", 1)), int(options["last_page"])
    pages = [uri.replace("{page}", str(page)) for page in range(first, last + 1)]
    return read_json(spark, pages, {"multi_line": True, **options}, row_limit)


FORMATS: dict[str, Reader] = {
    "zip_csv": read_zip_csv,
    "http_zip_csv": read_zip_csv,
    "csv": read_csv,
    "json": read_json,
    "json_pages": read_json_pages,
}


def open_source(
    spark: SparkSession, source_format: str, uri: Address, options: Options, row_limit: int | None = None
) -> Opened:
    """Read a source; ``row_limit`` is the number of rows in all, whatever the format and files."""
    if source_format not in FORMATS:
        raise ValueError(f"Unsupported source format: {source_format}")
    if row_limit is not None and row_limit <= 0:
        raise ValueError(f"row_limit must be positive, got {row_limit}")
    opened = FORMATS[source_format](spark, uri, options, row_limit)
    if row_limit is not None and opened.landing is None:
        opened.rows = opened.rows.limit(row_limit)
    return opened


def read_source(
    spark: SparkSession, source_format: str, uri: Address, options: Options, row_limit: int | None = None
) -> DataFrame:
    """The rows alone; what was landed for them stays until the shared folder is cleared."""
    return open_source(spark, source_format, uri, options, row_limit).rows
