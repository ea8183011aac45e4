"""Token ids as flat binary files with document offsets, written and memory-mapped by Spark's tasks.

The format: a folder of shards. Shard k has three flat files. ``ids`` holds every document's ids one
after another, as little-endian unsigned 32-bit or 16-bit numbers. ``offsets`` holds one
little-endian 64-bit number per document and one more: the place of each document's first id,
counted over *all* shards. ``docs`` holds the documents' ids as little-endian 64-bit numbers, then
one byte for each that is 1 where the id is null. Documents are in ascending ``doc_id`` order over the
shards, so document i of a shard is ``ids[offsets[i] - offsets[0] : offsets[i + 1] - offsets[0]]``.

Writing: range partitioning puts the documents in order; each task encodes its own and writes ``ids``
and ``docs`` shard by shard. The bases of the partitions are the prefix sum over one number per
partition; with them tasks write ``offsets`` from the lengths. Files carry the number of the attempt
that wrote them, and a small table, committed by Spark, names those of the attempts that count: a
file that a lost or repeated attempt left is never read.

Reading back: tasks map ``ids`` and ``offsets`` (``numpy.memmap``) and cut the ids by the offsets.

The folder must be one that every machine has mounted at the same path, because files are mapped:
the shared folder of the cluster, or ``folder``. An address of another kind is refused.

Defined cases: a null or empty text has the end id alone; a very long text is one document of its
shard, which then is as long; null ids come first, equal ones in any order among themselves; other
columns are not read, whatever their names; an empty table gives no shard and no row.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollbook.llm.tokens import BYTE_LEVEL, encoder
from rollbook.session import scratch_path, written

_SHARD = "partition int, number int, inside long, n_ids long, n_docs long, name string, lengths binary"


def narrowest(tokenizer: str) -> int:
    """Bytes of the unsigned integers that hold every id of a tokenizer's file."""
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True)
    return 2 if max(vocabulary.values()) < 1 << 16 else 4


def mounted(address: str) -> str:
    """The path of a folder that can be memory-mapped."""
    parts = urlsplit(address)
    if parts.scheme not in ("", "file") or parts.netloc:
        raise ValueError(f"token files are memory-mapped and need a mounted folder, not {address}")
    return unquote(parts.path) if parts.scheme else address


def _offsets_name(name: str) -> str:
    return f"offsets-{name}.bin"


def encode_shards(
    docs: DataFrame, tokenizer: str, end_id: int, shard_ids: int, width: int, folder: str
) -> DataFrame:
    """Write documents in ``doc_id`` order as shards of about ``shard_ids`` ids; gives a row for each,
    ``number`` orders those of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, BYTE_LEVEL).encode
        task = TaskContext.get()
        partition, attempt = task.partitionId(), task.taskAttemptId()
        os.makedirs(folder, exist_ok=True)
        end = np.array([end_id], dtype="<u4").tobytes()
        number, inside = 0, 0
        coded: list[bytes] = []
        doc_ids: list[int | None] = []
        n = 0

        def shard() -> pa.RecordBatch:
            name = f"{partition:06d}-{number:06d}-{attempt}"
            ids = np.frombuffer(end.join([*coded, b""]), dtype="<u4")
            if width == 2 and len(ids) and ids.max() >= 1 << 16:
                raise ValueError("an id does not fit into 16 bits")
            ids.astype(f"<u{width}").tofile(f"{folder}/ids-{name}.bin")
            with open(f"{folder}/docs-{name}.bin", "wb") as out:
                out.write(np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes())
                out.write(np.array([d is None for d in doc_ids], dtype="u1").tobytes())
            lengths = np.array([len(c) // 4 + 1 for c in coded], dtype="<i8").tobytes()
            values = [partition, number, inside, len(ids), len(coded), name, lengths]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["partition", "number", "inside", "n_ids", "n_docs", "name", "lengths"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 200):
                part = encode(texts[at : at + 200])
                coded += part
                doc_ids += batch.column("doc_id")[at : at + 200].to_pylist()
                n += sum(map(len, part)) // 4 + len(part)
                if n >= shard_ids:
                    yield shard()
                    number, inside, n = number + 1, inside + n, 0
                    coded, doc_ids = [], []
        if coded:
            yield shard()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return ordered.mapInArrow(run, _SHARD)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, shard_ids: int = 1 << 20, width: int = 4, folder: str | None = None
) -> DataFrame:
    """Write the files; gives the table of shards, ``folder`` and ``name`` of each, and its ``base``: the
    ids before it."""
    folder = mounted(folder or scratch_path(docs.sparkSession, "token-files"))
    shards = written(encode_shards(docs, tokenizer, end_id, shard_ids, width, folder), "token-shards")
    sums = shards.groupBy("partition").agg(F.sum("n_ids").alias("n")).orderBy("partition")
    total, before = 0, []
    for row in sums.toLocalIterator():
        before.append((row["partition"], total))
        total += row["n"]
    # One pair of numbers per task of the writing stage, whatever the number of documents.
    bases = docs.sparkSession.createDataFrame(before, "partition int, before long")
    placed = shards.join(F.broadcast(bases), "partition").withColumn("base", F.col("before") + F.col("inside"))

    def put_offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for row in batch.itertuples():
                lengths = np.frombuffer(row.lengths, dtype="<i8")
                offsets = row.base + np.concatenate([[0], np.cumsum(lengths)])
                # Every attempt writes the same numbers, and shows them only whole.
                own = f"{folder}/{_offsets_name(row.name)}.{attempt}"
                offsets.astype("<i8").tofile(own)
                os.replace(own, f"{folder}/{_offsets_name(row.name)}")
            out = batch[["partition", "number", "base", "n_ids", "n_docs", "name"]]
            yield out.assign(folder=folder)

    schema = "partition int, number int, base long, n_ids long, n_docs long, name string, folder string"
    return written(placed.mapInPandas(put_offsets, schema), "token-files-shards")


def map_shard(folder: str, name: str, width: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's offsets, doc_ids, which of those are null, and ids, memory-mapped."""
    offsets = np.memmap(f"{folder}/{_offsets_name(name)}", dtype="<i8", mode="r")
    docs, n = f"{folder}/docs-{name}.bin", len(offsets) - 1
    doc_ids = np.memmap(docs, dtype="<i8", mode="r", shape=(n,))
    nulls = np.memmap(docs, dtype="u1", mode="r", offset=8 * n, shape=(n,))
    return offsets, doc_ids, nulls, np.memmap(f"{folder}/ids-{name}.bin", dtype=f"<u{width}", mode="r")


def read_token_files(files: DataFrame, width: int = 4) -> DataFrame:
    """Per document, from the files: start, number of ids, and crc32 of its ids as 32-bit numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.itertuples():
                offsets, doc_ids, nulls, ids = map_shard(row.folder, row.name, width)
                places = (offsets - offsets[0]).tolist()
                whole = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(whole[4 * a : 4 * b]) for a, b in zip(places, places[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(doc_ids), pa.int64(), mask=nulls.astype(bool)), pa.array(np.array(offsets[:-1])),
                        pa.array(np.diff(offsets)), pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(b.to_pandas() for b in batches)

    return files.select("folder", "name").mapInArrow(
        frames, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
