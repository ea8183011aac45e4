"""Landing: files that cannot be split are taken apart once, into text that can.

A zip archive has no entry points, so one task streams each archive: every compressed byte is read
once, the records of its table are told apart (quotes respected) and written to shared storage, one
line each, in parts of ``part_bytes``. Fields are parted by U+001F and records by U+001E, so that no
quote is left and Spark's text reader may split the parts wherever it likes and cut the fields in
generated code. Addresses over HTTP are streamed to shared storage first, with retries; the
server need not serve ranges.

A task writes into a folder of its own attempt and names it in its result, so an attempt that
fails or is beaten leaves nothing that is read. ``Landing.drop`` removes the whole folder.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import posixpath
import sys
import time
import urllib.request
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import islice
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rollbook.session import scratch_path

# Executors need not have this package installed: what their tasks run travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELD, RECORD, ESCAPE = "\x1f", "\x1e", "\x1b"
#: How these three look inside a field, and a record without any field.
ESCAPES = {ESCAPE: f"{ESCAPE}0", RECORD: f"{ESCAPE}1", FIELD: f"{ESCAPE}2"}
NO_FIELDS = f"{ESCAPE}3"

PART_BYTES = 128 << 20
CHUNK_BYTES = 8 << 20
HTTP_TIMEOUT_SECONDS = 120
HTTP_ATTEMPTS = 5

Opener = Callable[..., BinaryIO]


# Addresses.


def is_http(uri: str) -> bool:
    return uri.startswith(("http://", "https://"))


def matching_files(address: str | Sequence[str]) -> list[str]:
    """Files of an address: a path, a glob on its last part, several after commas, or a list."""
    parts = address.split(",") if isinstance(address, str) else address
    return [uri for part in parts for uri in _matches(part.strip())]


def _matches(pattern: str) -> list[str]:
    if is_http(pattern) or not any(c in pattern for c in "*?["):
        return [pattern]
    folder, name = posixpath.split(pattern)
    filesystem, path = fs.FileSystem.from_uri(folder)
    prefix = folder[: len(folder) - len(path)] if folder.endswith(path) else ""
    found = sorted(
        prefix + f.path
        for f in filesystem.get_file_info(fs.FileSelector(path))
        if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name, name)
    )
    if not found:
        raise FileNotFoundError(f"No file matches {pattern}")
    return found


def fetch(
    uri: str,
    target: str,
    opener: Opener = urllib.request.urlopen,
    attempts: int = HTTP_ATTEMPTS,
    pause: Callable[[float], None] = time.sleep,
) -> int:
    """Stream an address to shared storage; gives its bytes.

    A broken or short transfer begins anew, after 1, 2, 4 seconds and so on; what the server
    refuses for good (4xx other than 408 and 429) is not asked for again.
    """
    filesystem, path = fs.FileSystem.from_uri(target)
    filesystem.create_dir(posixpath.dirname(path))
    for attempt in range(attempts):
        try:
            with opener(uri, timeout=HTTP_TIMEOUT_SECONDS) as response, filesystem.open_output_stream(path) as out:
                expected = response.headers.get("Content-Length")
                size = 0
                while chunk := response.read(CHUNK_BYTES):
                    out.write(chunk)
                    size += len(chunk)
            if expected is not None and size != int(expected):
                raise OSError(f"{uri} ended after {size} of {expected} bytes")
            return size
        except OSError as error:
            code = getattr(error, "code", None)
            refused = code is not None and 400 <= code < 500 and code not in (408, 429)
            if refused or attempt == attempts - 1:
                raise
            pause(2.0**attempt)
    raise ValueError("at least one attempt is needed")


# Archives.


class _Counted(io.RawIOBase):
    """A seekable file that counts the bytes read from it."""

    def __init__(self, file: pa.NativeFile):
        self._file, self.bytes_read = file, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        return self._file.seek(offset, whence)

    def readinto(self, buffer) -> int:
        data = self._file.read(len(buffer))
        buffer[: len(data)] = data
        self.bytes_read += len(data)
        return len(data)


def choose_member(archive: zipfile.ZipFile) -> zipfile.ZipInfo:
    """The first ``.csv`` member, else the first member that is a file."""
    files = [m for m in archive.infolist() if not m.is_dir()]
    tables = [m for m in files if m.filename.lower().endswith(".csv")]
    if not files:
        raise FileNotFoundError(f"No file inside {archive.filename}")
    return (tables or files)[0]


@contextmanager
def _table(uri: str, encoding: str) -> Iterator[tuple[io.TextIOBase, _Counted]]:
    """The text of an archive's table, decompressed as it is read."""
    filesystem, path = fs.FileSystem.from_uri(uri)
    with filesystem.open_input_file(path) as file:
        counted = _Counted(file)
        with zipfile.ZipFile(io.BufferedReader(counted, 1 << 20)) as archive, archive.open(choose_member(archive)) as member:
            yield io.TextIOWrapper(io.BufferedReader(member, 1 << 20), encoding=encoding), counted


def _line(fields: list[str]) -> str:
    """A record as text without quotes; what stands for a separator inside a field is written otherwise."""
    if not fields:
        return NO_FIELDS
    line = FIELD.join(fields)
    if ESCAPE in line or RECORD in line or line.count(FIELD) != len(fields) - 1:
        table = str.maketrans(ESCAPES)
        line = FIELD.join(f.translate(table) for f in fields)
    return line


def _lines(records: list[list[str]], fields: int) -> str:
    """The records, which have so many fields together, as text. They are joined all at once; only where
    a separator stands inside a field, or a record has no field, each is looked at."""
    text = RECORD.join(map(FIELD.join, records))
    plain = ESCAPE not in text and text.count(RECORD) == len(records) - 1
    if plain and text.count(FIELD) == fields - len(records) and all(records):
        return text
    return RECORD.join(map(_line, records))


class _Parts:
    """Lines into files of about ``part_bytes`` in one folder."""

    def __init__(self, folder: str, part_bytes: int):
        self._filesystem, self._folder = fs.FileSystem.from_uri(folder)
        self._filesystem.create_dir(self._folder)
        self._limit, self._out, self._size, self.count, self.text_bytes = part_bytes, None, 0, 0, 0

    def write(self, lines: str) -> None:
        data = (lines + RECORD).encode()
        if self._out is None:
            self._out = self._filesystem.open_output_stream(f"{self._folder}/part-{self.count:06d}.txt")
            self._size, self.count = 0, self.count + 1
        self._out.write(data)
        self._size += len(data)
        self.text_bytes += len(data)
        if self._size >= self._limit:
            self.close()

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None


@dataclass(frozen=True)
class TextFormat:
    delimiter: str = ","
    encoding: str = "utf-8"
    has_header: bool = True


class Landed(NamedTuple):
    """What a task reports of an archive."""

    archive: int
    uri: str
    rows: str
    odd_rows: str
    header: list[str] | None
    records: int
    odd_records: int
    parts: int
    bytes_read: int
    text_bytes: int


_MANIFEST = (
    "archive long, uri string, rows string, odd_rows string, header array<string>, records long, "
    "odd_records long, parts long, bytes_read long, text_bytes long"
)


def land_archive(
    number: int, uri: str, folder: str, text: TextFormat, width: int | None, limit: int | None, part_bytes: int
) -> Landed:
    """Take one archive apart; ``width`` is the number of declared columns, if they are declared.

    Records of another width than the header or the declaration are also written apart, with the
    archive and their place in it.
    """
    csv.field_size_limit(sys.maxsize)
    attempt = f"{number:06d}-{uuid.uuid4().hex[:12]}"
    rows = _Parts(f"{folder}/rows/{attempt}", part_bytes)
    odd = _Parts(f"{folder}/odd/{attempt}", part_bytes)
    source, transferred = uri, 0
    if is_http(uri):
        source = f"{folder}/fetched/{attempt}.zip"
        transferred = fetch(uri, source)
    header, records, odd_records = None, 0, 0
    with _table(source, text.encoding) as (file, counted):
        reader = csv.reader(file, delimiter=text.delimiter)
        if text.has_header:
            header = next(reader, [])
            if not header:
                raise ValueError(f"{uri} has no header line")
            if len(set(header)) < len(header):
                raise ValueError(f"{uri} names a column twice in its header")
            width = len(header)
        wanted = islice(reader, limit)
        while batch := list(islice(wanted, 8192)):
            widths = list(map(len, batch))
            rows.write(_lines(batch, sum(widths)))
            wrong = len(batch) - widths.count(width)
            if wrong:
                told = (
                    _line([uri, str(records + i + 1), *batch[i]]) for i, found in enumerate(widths) if found != width
                )
                odd.write(RECORD.join(told))
            records, odd_records = records + len(batch), odd_records + wrong
    rows.close()
    odd.close()
    if source != uri:
        filesystem, path = fs.FileSystem.from_uri(source)
        filesystem.delete_file(path)
    return Landed(
        number, uri, f"{folder}/rows/{attempt}", f"{folder}/odd/{attempt}", header, records, odd_records,
        rows.count, transferred or counted.bytes_read, rows.text_bytes,
    )


# Reading what landed.


def _restored(value: Column) -> Column:
    restored = value
    for plain, escaped in reversed(ESCAPES.items()):
        restored = F.replace(restored, F.lit(escaped), F.lit(plain))
    return F.when(F.contains(value, F.lit(ESCAPE)), restored).otherwise(value)


def _fields() -> Column:
    line = F.col("value")
    return F.when(line == NO_FIELDS, F.array().cast("array<string>")).otherwise(F.split(line, FIELD, -1))


@dataclass
class Landing:
    """The archives of a source as records in shared storage."""

    spark: SparkSession
    folder: str
    archives: list[Landed]
    columns: Sequence[str] = field(default_factory=tuple)

    def rows(self, strict: bool = False) -> DataFrame:
        """Every record, by column name; ``strict`` leaves those of a wrong width out.

        With headers the columns are those of all archives, in the order they first appear, and
        NULL where an archive does not have one. Short records are filled with NULL, long ones cut.
        """
        columns = self.columns or list(dict.fromkeys(c for a in self.archives for c in a.header))
        schema = StructType([StructField(c, StringType()) for c in columns])
        by_header: dict[tuple, list[str]] = {}
        for archive in self.archives:
            if archive.records:
                by_header.setdefault(tuple(self.columns or archive.header), []).append(archive.rows)
        out = None
        for header, folders in by_header.items():
            place = {name: i for i, name in enumerate(header)}
            lines = self.spark.read.option("lineSep", RECORD).text(folders).select(_fields().alias("fields"))
            if strict:
                lines = lines.filter(F.size("fields") == len(header))
            part = lines.select(
                *(
                    (_restored(F.get("fields", F.lit(place[c]))) if c in place else F.lit(None).cast("string")).alias(c)
                    for c in columns
                )
            )
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], schema) if out is None else out

    def odd_rows(self) -> DataFrame:
        """Records of a wrong width: file, place in it (from 1, without the header), all fields."""
        folders = [a.odd_rows for a in self.archives if a.odd_records]
        if not folders:
            return self.spark.createDataFrame([], "source_file string, record_number long, fields array<string>")
        lines = self.spark.read.option("lineSep", RECORD).text(folders).select(F.split("value", FIELD, -1).alias("f"))
        return lines.select(
            _restored(F.get("f", F.lit(0))).alias("source_file"),
            F.get("f", F.lit(1)).cast("long").alias("record_number"),
            F.transform(F.slice("f", 3, F.greatest(F.size("f") - 2, F.lit(0))), _restored).alias("fields"),
        )

    def drop(self) -> None:
        drop_folder(self.folder)


def drop_folder(folder: str) -> None:
    filesystem, path = fs.FileSystem.from_uri(folder)
    if filesystem.get_file_info(path).type == fs.FileType.Directory:
        filesystem.delete_dir(path)


def land(
    spark: SparkSession,
    address: str | Sequence[str],
    text: TextFormat,
    columns: Sequence[str] = (),
    row_limit: int | None = None,
    part_bytes: int = PART_BYTES,
) -> Landing:
    """Land all archives of an address, one task for each.

    With a row limit one task takes the archives in order until it has so many records, so the
    sample is always the same.
    """
    uris = matching_files(address)
    folder = scratch_path(spark, "landed")
    width = len(columns) or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = row_limit
        for batch in batches:
            for number in batch.column("id").to_pylist():
                if left == 0:
                    return
                done = land_archive(number, uris[number], folder, text, width, left, part_bytes)
                if left is not None:
                    left -= done.records
                batch = pa.RecordBatch.from_pylist([done._asdict()])
                header = batch.column("header").cast(pa.list_(pa.string()))
                yield batch.set_column(batch.schema.get_field_index("header"), "header", header)

    tasks = 1 if row_limit is not None else len(uris)
    try:
        reported = spark.range(0, len(uris), 1, tasks).mapInArrow(run, _MANIFEST).collect()
    except Exception:
        drop_folder(folder)
        raise
    archives = sorted((Landed(*r) for r in reported), key=lambda a: a.archive)
    return Landing(spark, folder, archives, tuple(columns))


def land_files(spark: SparkSession, uris: Sequence[str], suffix: str) -> tuple[str, list[str]]:
    """Plain files over HTTP, each streamed to shared storage by a task: the folder and the files."""
    folder = scratch_path(spark, "fetched")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("id").to_pylist():
                target = f"{folder}/{number:06d}-{uuid.uuid4().hex[:12]}{suffix}"
                fetch(uris[number], target)
                yield pa.RecordBatch.from_pylist([{"id": number, "file": target}])

    reported = spark.range(0, len(uris), 1, len(uris)).mapInArrow(run, "id long, file string").collect()
    return folder, [r.file for r in sorted(reported)]
