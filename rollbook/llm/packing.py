"""Best-fit packing of documents into sequences, certified by lower bounds and repaired by exchange.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens; a piece that is full is
a sequence by itself. The others are dealt at random over partitions, each packed best-fit
decreasing. Dual-feasible functions bound from below the number of bins any packing of a
partition needs. A partition that meets its bound is certified. From the others all bins with room
to spare are taken, whole, dealt over new partitions with those of other partitions, and packed
again; a partition's new packing is taken if it has fewer bins than came in. That goes on for
``rounds`` rounds or until no partition has a gap.

Texts are encoded some hundred at a time, from batches of ``BATCH_ROWS`` rows, with a bounded table
of parts, so what a worker process holds depends neither on the input nor on a batch's texts.
Partitions hold about ``partition_rows`` pieces, so what one task packs does not grow with the
input, and a hot length or a group of copies is dealt like anything else. Within a partition pieces
of one length are handled together.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; rows with a
null or repeated ``doc_id`` keep their own pieces; other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import small_batches
from rollbook.llm.tokens import SPACE_DROPPED, encoder
from rollbook.session import written

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
#: Texts that are in a task's memory as strings and as ids at one time.
AT_ONCE = 200
#: Rows of a batch on its way to Python; Spark's 10,000 are some 30 MB of text on both sides.
BATCH_ROWS = 1000
#: Parts whose ids a worker process keeps in each generation: some 50 MB.
KEPT_PARTS = 300_000


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Each document's pieces; the tokenizer file is read where the tasks run."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, SPACE_DROPPED, KEPT_PARTS).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in _slices(batches):
            rows = []
            for number, ids in enumerate(encode(batch.column("text").to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((number, k, at // 4, len(part) // 4, zlib.crc32(part)))
            number, piece, start, length, crc = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            columns = [batch.column("doc_id").take(pa.array(number)), pa.array(piece.astype(np.int32))]
            columns += [pa.array(start), pa.array(length), pa.array(crc)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select("doc_id", text).mapInArrow(run, PIECES.format(id=kind))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length. Longest first, each into the fullest bin that still takes it.

    ``rooms[r]`` lists the open bins with r tokens left; the tightest fitting room is found by
    the lowest set bit of a mask, so an item costs the same however many bins are open.
    """
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(lengths), dtype=np.int64)
    rooms: dict[int, list[int]] = {}
    open_rooms = 0
    bins = 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = open_rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            stack = rooms[room]
            number = stack.pop()
            if not stack:
                open_rooms &= ~(1 << room)
        else:
            room, number = capacity, bins
            bins += 1
        out[i] = number
        left = room - length
        if left:
            rooms.setdefault(left, []).append(number)
            open_rooms |= 1 << left
    return out


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    A dual-feasible function maps the sizes of any feasible bin to values that add up to one bin at
    most, so the mapped total, rounded up, bounds the bins. ``u_k`` (rounding (k+1)x down to whole
    parts unless it is whole) and the threshold functions (sizes over capacity - t count as whole
    bins, those below t as nothing) are evaluated on the histogram of lengths; the identity among
    them is the bound by volume.
    """
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for k in range(1, 101):
        scaled = (k + 1) * sizes
        # In units of 1 / (k * capacity): whole multiples keep their size.
        value = np.where(scaled % capacity == 0, k * sizes, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    big = np.cumsum(np.concatenate([[0], counts]))
    volume = np.cumsum(np.concatenate([[0], counts * sizes]))
    for t in range(0, capacity // 2 + 1):
        low = np.searchsorted(sizes, t)  # sizes below t count nothing
        high = np.searchsorted(sizes, capacity - t, side="right")
        whole = int(big[-1] - big[high])
        best = max(best, whole - (-int(volume[high] - volume[low]) // capacity))
    return best


def _placed(rows: pd.DataFrame, bins: np.ndarray, capacity: int) -> pd.DataFrame:
    out = rows.assign(bin=bins)
    out["room"] = capacity - out.groupby("bin")["length"].transform("sum")
    return out


#: A piece and where it lies: ``part`` and ``bin`` name the sequence, ``room`` is what is left in it.
_STATE = "row long, length long, part long, bin long, room long, gap boolean"


def _pack(rows: DataFrame, capacity: int) -> DataFrame:
    """Pack each partition ``part``; rows that come with bins keep them unless the new are fewer."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        lengths = part["length"].to_numpy()
        new = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        fewest = int(new.max()) + 1
        if "old" in part and part["old"].nunique() <= fewest:
            new = np.unique(part["old"].to_numpy(), return_inverse=True)[1]
            fewest = int(new.max()) + 1
        out = _placed(part[["row", "length"]].reset_index(drop=True), new, capacity)
        return out.assign(part=key[0], gap=fewest > bound)[["row", "length", "part", "bin", "room", "gap"]]

    return rows.groupBy("part").applyInPandas(run, _STATE)


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    partition_rows: int = 20_000,
    rounds: int = 3,
) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``."""
    # The id of a row names a piece also where documents share an id; it is stored, not recomputed.
    cut = pieces(docs, tokenizer, capacity).withColumn("row", F.monotonically_increasing_id())
    with small_batches(docs.sparkSession, BATCH_ROWS):
        cut = written(cut, "packing-pieces")
    short = cut.where(F.col("length") < capacity).select("row", "length")
    n = short.count()
    parts = max(1, math.ceil(n / partition_rows))
    dealt = short.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    state = written(_pack(dealt, capacity), "packing-0")
    done = []
    base = parts
    for number in range(1, rounds + 1):
        loose = F.col("gap") & (F.col("room") > 0)
        done.append(state.where(~loose))
        rest = state.where(loose)
        left, was = rest.agg(F.count(F.lit(1)), F.countDistinct("part")).first()
        if not left or was < 2:
            done.append(rest)
            break
        parts = max(1, math.ceil(left / partition_rows))
        # Bins move whole, so that a partition can tell what it has gained.
        name = F.xxhash64("part", "bin")
        target = F.pmod(F.xxhash64(name, F.lit(number)), F.lit(parts)) + F.lit(base)
        moved = rest.select("row", "length", target.alias("part"), name.alias("old"))
        state = written(_pack(moved, capacity), f"packing-{number}")
        base += parts
    else:
        done.append(state)
    packed = done[0]
    for more in done[1:]:
        packed = packed.unionByName(more)
    # Offsets run over a sequence's pieces, at most ``capacity`` of them.
    sequence = F.xxhash64("part", "bin")
    before = "SUM(length) OVER (PARTITION BY part, bin ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = packed.select(
        "row",
        (F.col("part") * (1 << 32) + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.expr(before), F.lit(0)).cast("long").alias("offset"),
    )
    # Full pieces are numbered below zero, by their row.
    alone = -F.col("row") - 1
    out = cut.join(placed, "row", "left")
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence_id", alone).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )
