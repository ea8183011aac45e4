"""Ranked lexical search over hashed max-sketches.

The index is one row per document, built in one pass with no shuffle. Its *sketch* has two rows of
counters (bytes); a term falls into one counter of each by two parts of its hash, and a counter
keeps the largest number of occurrences of the terms that fall into it, so folding is a
coordinatewise maximum. A row is a power of two wide, ``spread`` times the document's distinct
terms at least: sketches grow with the text and stay as sharp. Beside it lie the distinct terms
with their counts, for exact scores.

A term's impact grows with its occurrences and the sketch never shows fewer than there are (a full
counter stands for any number). So the smaller of a term's two counters bounds its impact, and
the sum over an item's terms, weights included, bounds the score. Items are looked up in batches
(``batch`` items at a time are sent to the tasks, with their terms and weights): the counters of
all their terms for a block of documents make a matrix, times the weights the bounds of all pairs.

A task then takes each item's documents in descending order of their bounds and scores them
exactly, from whole counts in 64-bit integers, until the bound is below the ``top``-th best score
it has seen: nothing after that can be among the best. The tasks' best are merged by rank. A
bound is taken in single precision and raised by more than that can lose, so none is too small.

Defined cases: a null or empty text has no terms and is not counted in the number of documents;
without any term in the corpus, or in an item, there are no results for it; equal scores are in
order of doc_id, null ids last, rows with equal ids each count; a repeated item_id is ranked for
each of its rows; a very long text is one wide sketch, alone in its block if need be; no other
column is read, so their names do not matter; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.common import pack, unpack, utf8
from rollbook.session import written

#: A-Z become small, digits, small letters and all bytes beyond ASCII stay, what is left separates.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_FULL = 255
_INDEX = "doc_id long, n long, width int, sketch binary, terms binary, counts binary"
_FOUND = "item int, doc_id long, score long"
#: More than single precision can lose in a sum over an item's terms.
_RAISED = 1.0 + 1e-3


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))


def _places(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A term's counter in the first row and in the second, counted through."""
    low = (hashes & np.uint64(width - 1)).astype(np.int64)
    high = ((hashes >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64)
    return low, high + width


def sketch_of(hashes: np.ndarray, counts: np.ndarray, spread: int) -> tuple[int, np.ndarray]:
    """Width of a row and both rows one after the other."""
    width = 1 << max(4, int(spread * max(1, len(hashes)) - 1).bit_length())
    out = np.zeros(2 * width, dtype=np.uint8)
    shown = np.minimum(counts, _FULL).astype(np.uint8)
    for places in _places(hashes, width):
        np.maximum.at(out, places, shown)
    return width, out


def build_index(docs: DataFrame, spread: int = 8) -> DataFrame:
    """The written index: a row per document with at least one term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in _INDEX.split(", ")}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                counted = Counter(words)
                terms = list(counted)
                counts = np.fromiter(counted.values(), np.int64, len(counted))
                width, sketch = sketch_of(_hashes(terms), counts, spread)
                out["doc_id"].append(doc_id.as_py())
                out["n"].append(len(words))
                out["width"].append(width)
                out["sketch"].append(pack(sketch))
                out["terms"].append(pack(np.frombuffer(b" ".join(terms), np.uint8)))
                out["counts"].append(pack(counts.astype("<u4")))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out)
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return written(source.mapInArrow(run, _INDEX), "max-sketches")


@dataclass
class Batch:
    """Items by number, with the places of their distinct terms in ``terms``."""

    numbers: list[int]
    places: list[np.ndarray]
    terms: list[bytes]
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, items: list[tuple[int, bytes]]) -> Batch:
        known: dict[bytes, int] = {}
        places = [
            np.array(sorted({known.setdefault(t, len(known)) for t in terms_of(text)}), dtype=np.int64)
            for _, text in items
        ]
        return cls([n for n, _ in items], places, list(known))

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(self.terms))],
            dtype=np.int64,
        )


def _holding(index: DataFrame, batch: Batch) -> dict[int, int]:
    """How many documents hold each term of the batch."""
    shared = index.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(batch.terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        found = np.zeros(len(known), dtype=np.int64)
        for rows in batches:
            for packed in rows.column("terms"):
                held = known.keys() & set(unpack(packed.as_py(), "u1").tobytes().split(b" "))
                for term in held:
                    found[known[term]] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["term", "documents"])

    parts = index.select("terms").mapInArrow(run, "term long, documents long")
    return {r.term: r.documents for r in parts.groupBy("term").agg(F.sum("documents").alias("documents")).collect()}


class _Best:
    """The best documents of each item, best first."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.rows: list[list[tuple[int, float, int | None]]] = [[] for _ in range(items)]
        self.bar = np.zeros(items, dtype=np.int64)

    def add(self, item: int, scored: list[tuple[int, int | None]]) -> None:
        rows = self.rows[item]
        rows += [(-s, math.inf if d is None else d, d) for s, d in scored if s > 0]
        rows.sort(key=lambda row: row[:2])
        del rows[self.top :]
        if len(rows) == self.top:
            self.bar[item] = -rows[-1][0]


def _impact(count: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return (1_000_000_000 * count) // (1000 * count + 20 * m)


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str], at_once: int, most: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of equal width together, ``most`` bytes of sketches or ``at_once`` rows at a time."""
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            width = row[2]
            rows = held.setdefault(width, [])
            rows.append(row)
            if len(rows) >= min(at_once, max(1, most // width)):
                yield width, held.pop(width)
    yield from held.items()


def _search(index: DataFrame, batch: Batch, documents: int, occurrences: int, top: int, at_once: int, most: int) -> DataFrame:
    """Each task's best documents of each item of the batch."""
    shared = index.sparkSession.sparkContext.broadcast(batch)
    columns = [c.split()[0] for c in _INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        place_of = {t: i for i, t in enumerate(asked.terms)}
        hashes = _hashes(asked.terms)
        weights = np.zeros((len(asked.terms), len(asked.numbers)), dtype=np.float32)
        for item, places in enumerate(asked.places):
            weights[places, item] = asked.weights[places]
        best = _Best(len(asked.numbers), top)

        def bounds(width: int, rows: list[tuple], m: np.ndarray) -> np.ndarray:
            sketches = np.stack([unpack(r[3], "u1") for r in rows])
            first, second = _places(hashes, width)
            count = np.minimum(sketches[:, first], sketches[:, second])
            doc, term = np.nonzero(count)
            shown = count[doc, term].astype(np.int64)
            impact = np.zeros(count.shape, dtype=np.float32)
            impact[doc, term] = np.where(shown == _FULL, 1_000_000, _impact(shown, m[doc]))
            return (impact @ weights) * np.float32(_RAISED)

        def impacts(row: tuple, m: int) -> np.ndarray:
            terms = unpack(row[4], "u1").tobytes().split(b" ")
            counted = dict(zip(terms, unpack(row[5], "<u4").tolist(), strict=True))
            held = counted.keys() & place_of.keys()
            out = np.zeros(len(asked.terms), dtype=np.int64)
            count = np.array([counted[t] for t in held], dtype=np.int64)
            out[[place_of[t] for t in held]] = _impact(count, m)
            return out

        for width, rows in _blocks(batches, columns, at_once, most):
            m = np.array([100 - 50 + (50 * r[1] * documents) // occurrences for r in rows], dtype=np.int64)
            bound = bounds(width, rows, m)
            exact: dict[int, np.ndarray] = {}
            for item in np.flatnonzero((bound >= np.maximum(best.bar, 1)).any(axis=0)).tolist():
                places, column = asked.places[item], bound[:, item]
                order = np.argsort(-column, kind="stable")
                for at in range(0, len(order), top):
                    part = order[at : at + top]
                    part = part[column[part] >= max(1, best.bar[item])]
                    scored = []
                    for doc in part.tolist():
                        if doc not in exact:
                            exact[doc] = impacts(rows[doc], int(m[doc]))
                        scored.append((int((exact[doc][places] * asked.weights[places]).sum()), rows[doc][0]))
                    best.add(item, scored)
                    if len(part) < top:
                        break
        out = [(n, d, -s) for n, rows in zip(asked.numbers, best.rows, strict=True) for s, _, d in rows]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["item", "doc_id", "score"]
        )

    return index.select(*columns).mapInArrow(run, _FOUND)


def _batches(spark: SparkSession, items: DataFrame, batch: int) -> Iterator[list[tuple[int, bytes]]]:
    """Items by number, ``batch`` at a time: so many, and no more, are on the driver at once."""
    held = []
    for row in items.select("item", "text").toLocalIterator():
        held.append((row["item"], bytes(row["text"])))
        if len(held) == batch:
            yield held
            held = []
    if held:
        yield held


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 50,
    batch: int = 1000,
    spread: int = 8,
    at_once: int = 512,
    most: int = 1 << 24,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item."""
    spark = docs.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    index = build_index(docs, spread)
    totals = index.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("occurrences")).first()
    if not totals["documents"]:
        return spark.createDataFrame([], schema)
    numbered = items.select(F.col("item_id").cast("long").alias("item_id"), utf8().alias("text"))
    number = F.expr("CAST(row_number() OVER (ORDER BY item_id, text) AS INT)")
    numbered = written(numbered.withColumn("item", number), "search-items")
    parts = None
    for held in _batches(spark, numbered, batch):
        asked = Batch.of(held)
        if not asked.terms:
            continue
        asked.weigh(totals["documents"], _holding(index, asked))
        found = _search(index, asked, totals["documents"], totals["occurrences"], top, at_once, most)
        found = written(found, "search-best")
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        return spark.createDataFrame([], schema)
    rank = F.expr("row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST)")
    best = parts.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
