"""Sharded n-gram counts: blocks of documents ask shards of hashed keys for sums over the corpus.

A *block* is some million words of whole documents, stored as numbers: the hashes of its distinct
words, and for each document the places of its words among them. A block sends each
shard the keys it holds with numbers to add up, packed into one row per shard; a shard (keys with
the same leading bits of their hash) adds equal keys and answers every block with the sums, in
the order of its keys, so answers need no keys. This is a shuffled aggregate and a join back, on
arrays instead of rows: a row per pair of block and shard at most, and never more rows than keys.
Hot keys are combined in the block before anything moves, and their shard gets one number per block.

The number of shards follows the number of words, so what a shard's task holds does not grow with
the input. Word keys are whole 64-bit hashes. Where a request carries a single width of 6 bytes the
keys are the 48 bits after the shard's, among about a million keys of a shard: some 4e-9 of them
collide, at any input size, because the number of shards grows with the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.common import pack, pack_uint, small_batches, unpack, unpack_uint, utf8

BLOCK = "block long, doc_ids binary, flags binary, lengths binary, places binary, hashes binary"
#: The hash of what stands before a document's first word, and of its end: no word is empty.
START, END = np.uint64(0), np.uint64(1)
#: Documents that go to Python at one time.
BATCH_ROWS = 1000


@dataclass
class Block:
    """``places`` are the words of all documents one after another, as indices into ``hashes``."""

    number: int
    doc_ids: bytes
    flags: np.ndarray
    lengths: np.ndarray
    places: np.ndarray
    hashes: np.ndarray
    carried: dict[str, bytes] = field(default_factory=dict)


class _Numbers(dict):
    """Words as they come, numbered from 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Builder:
    def __init__(self, number: int):
        self.number, self.known, self.places = number, _Numbers(), []
        self.doc_ids, self.flags, self.lengths, self.n = [], [], [], 0

    def add(self, words: list[bytes]) -> None:
        self.places.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
        self.lengths.append(len(words))
        self.n += len(words)

    def row(self) -> dict[str, object]:
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.known), np.uint64, len(self.known))
        places = np.concatenate(self.places) if self.places else np.zeros(0, dtype=np.int64)
        # Frequent words get small numbers, which take less room.
        order = np.argsort(-np.bincount(places, minlength=len(hashes)), kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return {
            "block": self.number,
            "doc_ids": pa.array(self.doc_ids, pa.int64()),
            "flags": pack(np.array(self.flags, dtype=np.uint8)),
            "lengths": pack_uint(np.array(self.lengths, dtype=np.int64)),
            "places": pack_uint(rank[places]),
            "hashes": pack(hashes[order]),
        }


def ids_out(ids: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([ids], ["id"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def ids_in(data: bytes) -> pa.Array:
    """The document ids of a block, nulls included."""
    return pa.ipc.open_stream(data).read_all().column("id").combine_chunks()


def write_blocks(
    docs: DataFrame, words_of: Callable[[bytes], list[bytes]], flag: F.Column, block_words: int, kept: Kept
) -> DataFrame:
    """Documents as written blocks; ``flag`` is a small number kept for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        number, now = 0, _Builder(first)
        for batch in batches:
            columns = zip(batch.column("doc_id"), batch.column("text"), batch.column("flag"), strict=True)
            for doc_id, text, mark in columns:
                now.add(words_of(text.as_py()))
                now.doc_ids.append(doc_id.as_py())
                now.flags.append(mark.as_py())
                if now.n >= block_words:
                    yield _batch(now)
                    number += 1
                    now = _Builder(first + number)
        if now.doc_ids:
            yield _batch(now)

    def _batch(builder: _Builder) -> pa.RecordBatch:
        row = builder.row()
        row["doc_ids"] = ids_out(row["doc_ids"])
        kinds = {"block": pa.int64()}
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()], list(row)
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"), flag.cast("int").alias("flag"))
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return kept.keep(source.mapInArrow(run, BLOCK), "ngram_blocks")


class Kept:
    """The tables of one computation, bucketed by block, so that answers come to the blocks and the
    blocks stay in place. Leaving the ``with`` drops those that are left, also after a failure."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []

    def __enter__(self) -> Kept:
        return self

    def __exit__(self, *failure: object) -> None:
        while self.names:
            self.drop_oldest()

    def keep(self, blocks: DataFrame, label: str) -> DataFrame:
        name = f"{label}_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.names.append(name)
        blocks.write.bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
        return self.spark.table(name)

    def drop_oldest(self) -> None:
        """Give up the table that newer ones replace."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(0)}")


def block_of(row: object, *carried: str) -> Block:
    return Block(
        row.block,
        row.doc_ids,
        unpack(row.flags, "u1"),
        unpack_uint(row.lengths),
        unpack_uint(row.places),
        unpack(row.hashes, "<u8"),
        {c: getattr(row, c) for c in carried},
    )


#: What a block asks for: sorted distinct keys and, for each, some columns of numbers.
Request = tuple[np.ndarray, list[np.ndarray]]
_ASKED = "block long, part int, shard int, keys binary, width int, numbers array<binary>"


def _cut(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin in the sorted keys."""
    first = np.array([-(-(k << 64) // shards) for k in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, first), [len(keys)]]).astype(np.int64)


def exchange(
    blocks: DataFrame,
    ask: Callable[[Block], list[Request]],
    shards: list[int],
    answers: list[int],
    combine: Callable[[int, np.ndarray, np.ndarray, list[np.ndarray]], list[np.ndarray]],
    finish: Callable[[Block, list[list[np.ndarray]]], pd.DataFrame],
    schema: str,
    carried: tuple[str, ...] = (),
    narrow: tuple[int, ...] = (),
) -> DataFrame:
    """One round between blocks and shards.

    ``ask`` gives a block's requests, one for each kind of key; ``shards`` are their numbers of
    shards. For every kind, ``combine(kind, keys, group, columns)`` gets the rows of a shard sorted by
    key, with the group of each row and its number columns, and gives ``answers[kind]`` columns, one
    value for each row. ``finish`` gets the block and for each kind its answered columns, in the order of
    the keys asked. Kinds in ``narrow`` send keys as 48 bits. Keys must be well mixed hashes.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block = block_of(row, *carried)
                out = []
                for kind, (keys, columns) in enumerate(ask(block)):
                    cuts = _cut(keys, shards[kind])
                    for shard in np.flatnonzero(np.diff(cuts)):
                        a, b = cuts[shard], cuts[shard + 1]
                        out.append((
                            block.number, kind, int(shard), *_keys_out(keys[a:b], shards[kind], shard, kind in narrow),
                            [pack_uint(c[a:b]) for c in columns],
                        ))
                yield pd.DataFrame(out, columns=["block", "part", "shard", "keys", "width", "numbers"])

    def serve(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        kind = int(key[0])
        part = part.sort_values("block", kind="stable").reset_index(drop=True)
        keys = [_keys_in(k) for k in part["keys"]]
        sizes = np.array([len(k) for k in keys])
        everything = np.concatenate(keys)
        order = np.argsort(everything, kind="stable")
        ordered = everything[order]
        group = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        columns = []
        for c in range(len(part["numbers"].iloc[0])):
            columns.append(np.concatenate([unpack_uint(n[c]) for n in part["numbers"]])[order])
        solved = combine(kind, ordered, group, columns)
        ends = np.cumsum(sizes)
        back = []
        for values in solved:
            placed = np.empty(len(values), dtype=np.int64)
            placed[order] = values
            back.append([pack_uint(placed[e - s : e]) for s, e in zip(sizes, ends, strict=True)])
        return pd.DataFrame({
            "block": part["block"], "part": part["part"], "shard": part["shard"],
            "numbers": [list(row) for row in zip(*back, strict=True)],
        })

    def gather(key: tuple, own: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        block = block_of(next(own.itertuples()), *carried)
        back = back.sort_values(["part", "shard"])
        out = []
        for kind, n in enumerate(answers):
            mine = back[back["part"] == kind]["numbers"].tolist()
            out.append([
                np.concatenate([unpack_uint(m[c]) for m in mine]) if mine else np.zeros(0, dtype=np.int64)
                for c in range(n)
            ])
        return finish(block, out)

    asked = blocks.mapInPandas(send, _ASKED)
    answered = asked.groupBy("part", "shard").applyInPandas(serve, "block long, part int, shard int, numbers array<binary>")
    return blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(gather, schema)


def _keys_out(keys: np.ndarray, shards: int, shard: int, narrow: bool) -> tuple[bytes, int]:
    """Sorted keys as their differences, which take less room."""
    if narrow:
        first = np.uint64(-(-(int(shard) << 64) // shards))
        span = -(-(1 << 64) // shards)
        keys = (keys - first) >> np.uint64(max(0, span.bit_length() - 48))
    return pack_uint(np.diff(keys, prepend=np.uint64(0))), 6 if narrow else 8


def _keys_in(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_uint(data).view(np.uint64), dtype=np.uint64)


def sums(group: np.ndarray, column: np.ndarray) -> np.ndarray:
    """For each row the sum of the column over its group."""
    return np.bincount(group, weights=column).astype(np.int64)[group]


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A well mixed hash of two hashes, in order."""
    with np.errstate(over="ignore"):
        x = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(0x632BE59BD9B4E019))
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
