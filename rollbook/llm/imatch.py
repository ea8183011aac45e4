"""I-Match fingerprints of documents and of their edited texts.

Terms are runs of letters and digits in lower case. A term's document frequency over all documents
gives its inverse document frequency, and the fingerprint keeps the terms inside a band of it: in
``least`` documents or more and in at most a ``most`` part of them. A document with under a quarter
of its distinct terms below the band's upper end (a text that a large part of the corpus repeats)
is printed by all its terms that ``least`` documents hold, and so are the edits of such a text.

A *lexicon subset* is a random part of the band's terms: subset k of level l holds the terms whose
k-th seeded hash begins with l zero bits, one in 2**l. A document takes the three levels that leave it
about one term a subset or fewer, by the number of its terms, and the fingerprint lists, for each level
and each of ``subsets`` seeds, a hash of the sorted distinct terms that the subset keeps ("-" where it
keeps none). A change of a few terms leaves most subsets as they are. Two fingerprints' *likeness* is the
share of equal hashes among the subsets, of levels both have, where either kept a term.

Work: one pass counts document frequencies (partial counts per task meet in one shuffle). Texts then
move once, compressed, into ranges of doc_id, where a task streams its range in order and each text
meets the next one; the last text of a range meets the first of the next range through one row
per range. Subsets are drawn there, before the band's lower end is known, so what is asked of the
lexicon is a few terms per document, whatever its length; terms above the band are sent to all
tasks, and there are at most (mean distinct terms of a document) / ``most`` of them.

Defined cases: a null text is empty; a text none of whose subsets keeps a term has a hash of all its
distinct terms as fingerprint, like only to an equal one, and texts without terms are all alike;
equal fingerprints have likeness 1; a single document is its own next one; null ids come first and
equal ids are in order of a hash of the text, as in any order; very long texts are whole; no other
column is read, so their names do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import utf8
from rollbook.session import written

#: A-Z become small, digits, small letters and all bytes beyond ASCII stay, what is left separates.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_SKETCHED = "own binary, edited binary, own_whole string, edited_whole string, own_level int, edited_level int, asked array<long>"
_ROWS = f"part int, place long, doc_id long, n_chars long, edited_sha256 string, {_SKETCHED}, text binary"
_KNOWN_WORDS = 400_000
#: Levels of a fingerprint: texts whose numbers of terms differ up to fourfold share one.
LEVELS = 3


class _Hashes(dict):
    """64-bit hashes of terms; a bounded number of them is remembered."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(term)
        if len(term) <= 64:
            self[term] = value
        return value


def distinct_terms(text: bytes, known: _Hashes) -> np.ndarray:
    """Sorted hashes of the distinct terms."""
    terms = set(text.translate(_TERM_BYTES).split())
    out = np.fromiter(map(known.__getitem__, terms), np.uint64, len(terms))
    out.sort()
    return out


def _mixed(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Every term's hash under every seed, terms by seeds; its high bits are what counts."""
    return hashes[:, None] * seeds[None, :]


def _seeds(subsets: int) -> np.ndarray:
    """Odd numbers: a product with one keeps different hashes apart."""
    return np.array([xxhash.xxh64_intdigest(b"subset", seed=k) | 1 for k in range(subsets)], dtype=np.uint64)


def _threshold(level: int) -> np.uint64:
    return np.uint64((1 << (64 - level)) - 1) if level else np.uint64(0xFFFFFFFFFFFFFFFF)


class Sampler:
    """Which of a text's terms may be in its subsets, ``frequent`` ones being above the band."""

    def __init__(self, frequent: np.ndarray, subsets: int):
        self.frequent, self.seeds, self.known = frequent, _seeds(subsets), _Hashes()

    def is_frequent(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return self.frequent[at] == hashes

    def __call__(self, text: bytes) -> tuple[np.ndarray, int, str]:
        """Sorted hashes of the terms some subset draws, the lower level, a hash of all terms."""
        hashes = distinct_terms(text, self.known)
        whole = xxhash.xxh64_hexdigest(hashes.tobytes())
        inside = hashes[~self.is_frequent(hashes)]
        if 4 * len(inside) < len(hashes):
            inside = hashes
        level = max(0, len(inside).bit_length() - 1)
        drawn = _mixed(inside, self.seeds).min(axis=1, initial=np.uint64(0xFFFFFFFFFFFFFFFF)) <= _threshold(level)
        return inside[drawn], level, whole


def printed(hashes: np.ndarray, level: int, whole: str, seeds: np.ndarray) -> str:
    """The fingerprint from the drawn terms that are in the lexicon."""
    if not len(hashes):
        return f"all:{whole}"
    mixed = _mixed(hashes, seeds).T
    levels = range(level, level + LEVELS)
    kept = np.concatenate([mixed <= _threshold(each) for each in levels])
    subset, term = np.nonzero(kept)
    ends = (8 * np.searchsorted(subset, np.arange(len(kept) + 1))).tolist()
    data = hashes[term].tobytes()
    made = [xxhash.xxh32_hexdigest(data[x:y]) if x < y else "-" for x, y in zip(ends, ends[1:], strict=False)]
    k = len(seeds)
    return ";".join([f"{each}:{','.join(made[i * k : (i + 1) * k])}" for i, each in enumerate(levels)])


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if a.startswith("all:") or b.startswith("all:"):
        return 0.0
    levels = [dict(part.split(":") for part in text.split(";")) for text in (a, b)]
    same = either = 0
    for level in levels[0].keys() & levels[1].keys():
        for x, y in zip(levels[0][level].split(","), levels[1][level].split(","), strict=True):
            either += x != "-" or y != "-"
            same += x == y != "-"
    return same / either if either else 0.0


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term`` (a 64-bit hash) and ``documents`` for every term, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Hashes = _Hashes()
        counted: Counter = Counter()

        def out() -> pa.RecordBatch:
            terms = np.fromiter(counted.keys(), np.uint64, len(counted)).view(np.int64)
            counts = np.fromiter(counted.values(), np.int64, len(counted))
            return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(counts)], ["term", "documents"])

        for batch in batches:
            for text in batch.column("text"):
                terms = set(text.as_py().translate(_TERM_BYTES).split())
                counted.update(map(known.__getitem__, terms))
                if len(counted) >= 2_000_000:
                    yield out()
                    counted.clear()
        yield out()

    parts = docs.select(utf8().alias("text")).mapInArrow(run, "term long, documents long")
    return written(parts.groupBy("term").agg(F.sum("documents").alias("documents")), "imatch-terms")


def _sketched(docs: DataFrame, frequent: np.ndarray, subsets: int) -> DataFrame:
    """Per document: drawn terms of its text and of its edited text, in order of doc_id.

    A range's first and last rows keep their text, and the last has no edited text yet.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            columns = [
                batch.column("doc_id"),
                pa.array([squeeze(t) for t in texts], pa.binary()),
                pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts], pa.int64()),
                batch.column("tie"),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "hash", "tie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        sample = Sampler(shared.value, subsets)
        part = TaskContext.get().partitionId()
        place, held, out = 0, None, []

        def pairs() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                    yield doc_id.as_py(), expand(text.as_py())

        for doc_id, text in pairs():
            own = (doc_id, text, sample(text))
            if held is not None:
                edit = edited_text(held[1], text)
                out.append(row(part, place, held, edit, sample, held[1] if place == 0 else None))
                place += 1
                if len(out) >= 1000:
                    yield rows_out(out)
                    out = []
            held = own
        if held is not None:
            out.append(row(part, place, held, None, sample, held[1]))
            yield rows_out(out)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8().alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    ).mapInArrow(squeezed, "doc_id long, text binary, hash long, tie long")
    keys = [F.col("doc_id").asc_nulls_first(), "hash", "tie"]
    ordered = source.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(ordered.mapInArrow(run, _ROWS), "imatch-rows")


def edited_text(text: bytes, following: bytes) -> bytes:
    """The last quarter of the code points replaced by as many, or all, of the next text's first."""
    chars, other = text.decode(), following.decode()
    quarter = len(chars) // 4
    return (chars[: len(chars) - quarter] + other[:quarter]).encode()


def row(part: int, place: int, held: tuple, edit: bytes | None, sample: Sampler, keep: bytes | None) -> tuple:
    doc_id, text, (own, own_level, own_whole) = held
    edited, edited_level, edited_whole = sample(edit) if edit is not None else (own[:0], 0, "")
    asked = np.union1d(own, edited)
    asked = asked[~sample.is_frequent(asked)]
    sha = hashlib.sha256(edit).hexdigest() if edit is not None else None
    return (
        part, place, doc_id, len(text.decode()), sha, own.tobytes(), edited.tobytes(), own_whole, edited_whole,
        own_level, edited_level, asked.view(np.int64).tolist(), keep,
    )


_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def rows_out(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in _ROWS.split(", ")]
    columns = [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _ranges(rows: DataFrame) -> DataFrame:
    """Per range that holds rows: the place of its last row and the range after it; the last one
    is followed by the first. One row per range, in one task."""
    ends = rows.groupBy("part").agg(F.max("place").alias("last"))
    following = F.expr("coalesce(lead(part) OVER (ORDER BY part), first(part) OVER (ORDER BY part))")
    return written(ends.withColumn("following", following), "imatch-ranges")


def _completed(rows: DataFrame, ranges: DataFrame, frequent: np.ndarray, subsets: int) -> DataFrame:
    """The last rows of the ranges with their edited texts: each meets the first row of the next range."""
    lasts = rows.where("text IS NOT NULL").join(F.broadcast(ranges), "part").where("place = last")
    firsts = rows.where("place = 0").select(F.col("part").alias("following"), F.col("text").alias("first_text"))
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sampler(shared.value, subsets)
        for batch in batches:
            out = [
                row(r["part"], r["place"], (r["doc_id"], r["text"], sample(r["text"])), edited_text(r["text"], r["first_text"]), sample, None)
                for r in batch.to_pylist()
            ]
            if out:
                yield rows_out(out)

    met = lasts.join(firsts, "following").select("part", "place", "doc_id", "text", "first_text")
    return met.mapInArrow(run, _ROWS)


def _prints(sketched: DataFrame, frequent: np.ndarray, subsets: int) -> DataFrame:
    """Fingerprints from the drawn terms and those of them that the lexicon holds."""
    shared = sketched.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sampler(shared.value, subsets)

        def one(r: dict, which: str, known: np.ndarray) -> str:
            drawn = np.frombuffer(r[which], np.uint64)
            inside = drawn[sample.is_frequent(drawn) | np.isin(drawn, known)]
            return printed(inside, r[f"{which}_level"], r[f"{which}_whole"], sample.seeds)

        for batch in batches:
            rows = batch.to_pylist()
            known = [np.array(r["known"] or [], dtype=np.int64).view(np.uint64) for r in rows]
            prints = [[one(r, which, k) for r, k in zip(rows, known, strict=True)] for which in ("own", "edited")]
            kept = [batch.column(c) for c in ("part", "place", "doc_id", "n_chars", "edited_sha256")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(p, pa.string()) for p in prints)],
                ["part", "place", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"],
            )

    return sketched.mapInArrow(
        run,
        "part int, place long, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string",
    )


def imatch_fingerprints(docs: DataFrame, least: int = 2, most: float = 0.02, subsets: int = 16) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    terms = document_frequencies(docs)
    highest = max(least, int(most * docs.count()))
    above = terms.where(F.col("documents") > highest).select("term").toPandas()["term"]
    frequent = np.sort(above.to_numpy(dtype=np.int64).view(np.uint64))
    rows = _sketched(docs, frequent, subsets)
    ranges = _ranges(rows)
    inner = rows.join(F.broadcast(ranges), "part").where("place < last").select(*rows.columns)
    sketched = inner.unionByName(_completed(rows, ranges, frequent, subsets))

    asked = sketched.select("part", "place", F.explode("asked").alias("term"))
    lexicon = terms.where(F.col("documents").between(least, highest)).select("term")
    known = asked.join(lexicon, "term", "left_semi").groupBy("part", "place").agg(F.collect_list("term").alias("known"))
    prints = _prints(sketched.drop("asked", "text").join(known, ["part", "place"], "left"), frequent, subsets)
    prints = written(prints, "imatch-prints")

    at_end = F.col("place") == F.col("last")
    here = prints.join(F.broadcast(ranges), "part").select(
        *prints.columns,
        F.when(at_end, F.col("following")).otherwise(F.col("part")).alias("next_part"),
        F.when(at_end, F.lit(0)).otherwise(F.col("place") + 1).alias("next_place"),
    )
    after = prints.select(
        F.col("part").alias("next_part"), F.col("place").alias("next_place"), F.col("fingerprint").alias("next_fingerprint")
    )

    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    compared = F.pandas_udf(compare, "double")
    return here.join(after, ["next_part", "next_place"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        compared("fingerprint", "edited_fingerprint").alias("near_edited"),
        compared("fingerprint", "next_fingerprint").alias("near_next"),
    )
