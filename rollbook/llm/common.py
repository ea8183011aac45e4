"""What the operators of this package share: reading, words, packed arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.session import written

# The white space that separates words and is stripped from lines.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
NOT_SPACE_CLASS = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside goes to Python in batches of at most ``rows`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def utf8(column: str = "text") -> Column:
    """The column as UTF-8 bytes; null is empty.

    ``bytes.split()`` and ``bytes.lower()`` know exactly the white space and the A-Z above, and
    bytes need no decoding on their way to Python.
    """
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def sheltered(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The ``used`` columns, and the others in one struct, so that no name of theirs meets one that
    an operator gives; and a function that brings the columns back, with ``results`` after them."""
    others = [c for c in docs.columns if c not in used]
    inside = [F.struct(*[F.col(_quoted(c)) for c in others]).alias(CARRIED)] if others else []
    slim = docs.select(*[c for c in used if c in docs.columns], *inside)

    def restore(out: DataFrame, *results: str) -> DataFrame:
        """Columns named like a result, in any case of letters, are replaced by it."""
        taken = {r.lower() for r in results}
        columns = [c for c in docs.columns if c.lower() not in taken]
        back = [F.col(CARRIED).getField(c).alias(c) if c in others else F.col(c) for c in columns]
        return out.select(*back, *results)

    return slim, restore


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


#: The column that holds what an operator only passes on.
CARRIED = "_carried"
#: The column that tells rows apart, also where their ids are null or repeat.
ROW = "_row"


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number for each row, written so that it stays the row's own."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    value = F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder
    return F.coalesce(value, F.lit(False))


_pack = zstandard.ZstdCompressor(level=1)
_unpack = zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    return _pack.compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(_unpack.decompress(data), dtype=kind)


def pack_uint(values: np.ndarray) -> bytes:
    """Unsigned integers in the narrowest width that holds them; the first byte is the width."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    # Byte by byte: the high ones are mostly zero and take hardly any room together.
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + pack(planes)


def unpack_uint(data: bytes) -> np.ndarray:
    width = data[0]
    planes = unpack(data[1:], "u1").reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)
