"""Zip archives written by Spark tasks, as input for the archive reader."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.session import scratch_path


def archived(
    df: DataFrame,
    archives: int | None = None,
    delimiter: str = ";",
    encoding: str = "latin1",
    header: bool = False,
    member: str = "table.csv",
    others: dict[str, str] | None = None,
) -> str:
    """Write ``df`` into zip files, one per partition and at least ``archives``; returns their
    folder. ``others`` are members that come before the table's. A frame with the one column
    ``fields``, an array, gives records of any width.

    Spark's generated code writes the records as text; a task only encodes and compresses it."""
    names = df.columns if header else None
    # Dealt out only where there are too few partitions, so that large tables need no shuffle.
    if archives is not None and df.rdd.getNumPartitions() < archives:
        df = df.repartition(archives)
    lines = df.select(_record(df, delimiter).alias("line"))
    folder = scratch_path(df.sparkSession, "archives")
    filesystem, path = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(folder)
        # By partition, so that a task that runs again replaces its own archive.
        name = f"{root}/part-{TaskContext.get().partitionId():05d}.zip"
        rows = 0
        with (
            target.open_output_stream(name) as stream,
            zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive,
        ):
            for other, content in (others or {}).items():
                archive.writestr(other, content)
            with archive.open(member, "w", force_zip64=True) as table:
                if names:
                    first = io.StringIO(newline="")
                    csv.writer(first, delimiter=delimiter, quoting=csv.QUOTE_ALL).writerow(names)
                    table.write(first.getvalue().encode(encoding))
                for batch in batches:
                    table.write("".join(batch.column(0).to_numpy(zero_copy_only=False)).encode(encoding))
                    rows += batch.num_rows
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    lines.mapInArrow(write, "rows long").agg({"rows": "sum"}).collect()
    return folder


def _record(df: DataFrame, delimiter: str) -> Column:
    """A row as ``csv.writer`` writes it with every field quoted; NULL is an empty field."""

    def inside(value: Column) -> Column:
        return F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit('"'), F.lit('""'))

    between = f'"{delimiter}"'
    if df.columns == ["fields"]:
        fields = F.when(F.col("fields").isNull(), F.raise_error(F.lit("a record without fields"))).otherwise(F.col("fields"))
        full = F.concat(F.lit('"'), F.array_join(F.transform(fields, inside), between), F.lit('"\r\n'))
        return F.when(F.size(fields) == 0, "\r\n").otherwise(full)
    parts = [x for c in df.columns for x in (F.lit(between), inside(F.col(c)))]
    return F.concat(F.lit('"'), *parts[1:], F.lit('"\r\n'))


def paged(df: DataFrame, number: str, rows_per_page: int) -> tuple[str, int]:
    """Write ``df`` as pages of an API, numbered from 0, by a column that numbers its rows from 0;
    returns the pages' address and the number of the last one."""
    folder = scratch_path(df.sparkSession, "pages")
    filesystem, path = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(path)
    page = F.floor(F.col(number).cast("long") / rows_per_page).cast("int")

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        target, root = fs.FileSystem.from_uri(folder)
        records = rows.drop(columns="page").to_dict("records")
        with target.open_output_stream(f"{root}/page-{key[0]}.json") as out:
            out.write(json.dumps({"page": int(key[0]), "items": records}).encode())
        return pd.DataFrame({"page": [int(key[0])]})

    pages = df.withColumn("page", page).groupBy("page").applyInPandas(write, "page long")
    return f"{folder}/page-{{page}}.json", pages.agg({"page": "max"}).first()[0]
