"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

A 64-bit fingerprint is cut into a ring of 8 segments of 8 bits. If two fingerprints differ in at
most d bits, some segment starts a chain of which every prefix of l segments differs in at most
``l * d / 8`` bits. For d = 3 that means: 2 segments equal, 5 segments with at most one differing
bit, 7 with at most two. So among the third to fifth segment of the chain one at most differs, and
leaving out each in turn gives 3 keys of 32 equal bits for each of the 8 starts. Fingerprints that
share a key are candidates; the rest of the chain condition prunes them before the full Hamming
distance is taken. Any d from 0 to 7 is handled alike: the widest prefix with budget 0 is matched
exactly, the one with budget 1 with a segment left out.

Documents with one fingerprint are one node, whatever their number. Within a key's run of k
fingerprints the links come from comparing blocks, or, where k is large, from looking up all
fingerprints within the distance among the free bits, which is linear in k; a run reports a
spanning forest of its links, k - 1 rows at most, so nothing grows with the square of a group and
no link between components is lost.

Defined cases: null and empty texts have fingerprint zero and are linked like any others; a null
``doc_id`` never names a component unless all ids in it are null; repeated rows are linked by their
equal fingerprints; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import ROW, numbered, sheltered, utf8
from rollbook.llm.components import components
from rollbook.session import written

SEGMENTS = 8
WIDTH = 64 // SEGMENTS
SEED = 42
#: Runs up to this many fingerprints are compared in blocks, larger ones by lookups.
BLOCK = 2048


def fingerprint(text: bytes, shingle: int) -> int:
    """The bit is 1 where more than half of the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) > shingle:
        parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    else:
        parts = [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in parts], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, row: str | None = None) -> DataFrame:
    """``doc_id`` (and the column ``row``) and ``fp``, the fingerprint's 64 bits as a signed long."""
    held = ["doc_id", *([row] if row else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            fp = pa.array(np.array(bits, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in held], fp], [*held, "fp"])

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in held)
    return docs.select(*held, utf8().alias("text")).mapInArrow(run, kinds + "fp long")


def _budgets(distance: int) -> list[int]:
    """What the first l segments of a chain may differ, for l from 1."""
    return [l * distance // SEGMENTS for l in range(1, SEGMENTS + 1)]


def key_masks(distance: int) -> list[int]:
    """Bit masks such that fingerprints within ``distance`` agree under one of them at least."""
    budgets = _budgets(distance)
    exact = sum(b == 0 for b in budgets)
    one = sum(b <= 1 for b in budgets)
    masks = []
    for start in range(SEGMENTS):
        segments = [((1 << WIDTH) - 1) << WIDTH * ((start + l) % SEGMENTS) for l in range(one)]
        outs = range(exact, one) if one > exact else [None]
        masks += [sum(s for l, s in enumerate(segments) if l != out) for out in outs]
    return list(dict.fromkeys(masks))


_BITS = np.array([bin(i).count("1") for i in range(1 << WIDTH)], dtype=np.uint8)


def chained(differences: np.ndarray, distance: int) -> np.ndarray:
    """True where some chain of segments keeps within all its budgets."""
    counts = _BITS[np.ascontiguousarray(differences).view(np.uint8).reshape(-1, SEGMENTS)].astype(np.int16)
    passed = np.zeros(len(counts), dtype=bool)
    for start in range(SEGMENTS):
        sums = np.cumsum(np.roll(counts, -start, axis=1), axis=1)
        passed |= (sums <= np.array(_budgets(distance))).all(axis=1)
    return passed


def _distance(differences: np.ndarray) -> np.ndarray:
    return _BITS[np.ascontiguousarray(differences).view(np.uint8).reshape(-1, SEGMENTS)].sum(axis=1)


def _links(run: np.ndarray, mask: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the distinct sorted fingerprints of a run that are within the distance."""
    n = len(run)
    if n <= BLOCK:
        i, j = np.triu_indices(n, 1)
        for start in range(0, len(i), 1 << 18):
            a, b = i[start : start + (1 << 18)], j[start : start + (1 << 18)]
            differ = run[a] ^ run[b]
            near = chained(differ, distance)
            near[near] = _distance(differ[near]) <= distance
            yield a[near], b[near]
        return
    free = [np.uint64(1 << k) for k in range(64) if not mask >> k & 1]
    for bits in range(1, distance + 1):
        for chosen in combinations(free, bits):
            other = run ^ np.bitwise_or.reduce(np.array(chosen, dtype=np.uint64))
            at = np.minimum(np.searchsorted(run, other), n - 1)
            near = np.flatnonzero((run[at] == other) & (other > run))
            yield near, at[near]


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for first, second in links:
        for a, b in zip(first.tolist(), second.tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a, b))
    return out


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """Edges ``a, b`` between fingerprints, enough to connect all that are within ``distance``."""
    masks = key_masks(distance)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    keys = F.array(*[
        F.struct(F.lit(i).cast("int").alias("m"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for i, m in enumerate(masks)
    ])
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select("k.m", "k.key", "fp")

    def edges_of(m: int, run: np.ndarray) -> pd.DataFrame | None:
        run = np.unique(run.view(np.uint64))
        found = _forest(len(run), _links(run, masks[m], distance)) if len(run) > 1 else []
        if not found:
            return None
        a, b = np.array(found).T
        return pd.DataFrame({"a": run[a].view(np.int64), "b": run[b].view(np.int64)})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of equal keys; the last of a batch may go on in the next."""
        kept: list[np.ndarray] = []
        last = None
        for batch in batches:
            m, key, fp = (batch[c].to_numpy() for c in ("m", "key", "fp"))
            if not len(m):
                continue
            new = np.flatnonzero((m[1:] != m[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], new])
            ends = np.concatenate([new, [len(m)]])
            if last != (m[0], key[0]) and kept:
                if (edges := edges_of(last[0], np.concatenate(kept))) is not None:
                    yield edges
                kept = []
            out = []
            for s, e in zip(starts, ends, strict=True) if kept else _long(starts, ends, len(m)):
                part = [*kept, fp[s:e]]
                kept = []
                if e == len(m):
                    kept = part
                elif (edges := edges_of(m[s], np.concatenate(part))) is not None:
                    out.append(edges)
            last = (m[-1], key[-1])
            if out:
                yield pd.concat(out)
        if kept and (edges := edges_of(last[0], np.concatenate(kept))) is not None:
            yield edges

    def _long(starts: np.ndarray, ends: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        keep = (ends - starts > 1) | (ends == n)
        return zip(starts[keep], ends[keep], strict=True)

    sorted_runs = keyed.repartition("m", "key").sortWithinPartitions("m", "key")
    return sorted_runs.mapInPandas(scan, "a long, b long")


def _judged(docs: DataFrame, shingle: int, distance: int, row: str | None = None) -> DataFrame:
    """``doc_id, fp, root, component_id`` (and ``row``) for every row; ``root`` names a component."""
    prints = written(fingerprints(docs, shingle, row), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = links(distinct, distance)
    roots = written(components(edges), "simhash-roots")
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.select("fp", "root").join(ids, "root"), "fp")


def simhash_near_dedup(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row."""
    return _judged(docs, shingle, distance).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: the smallest id, null last, then the first row.

    Rows are told apart by a written number, so null and repeated ids lose nothing.
    """
    slim, restore = sheltered(docs, "doc_id", "text")
    rows = numbered(slim, "simhash-rows")
    found = written(_judged(rows, shingle, distance, ROW).select("root", "doc_id", ROW), "simhash-found")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col(f"first.{ROW}").alias("_kept"))
    kept = written(kept, "simhash-kept")
    # Written, so that Spark knows how few they are before it decides whether texts need a shuffle.
    gone = found.join(kept, F.col(ROW) == F.col("_kept"), "left_anti").select(F.col(ROW).alias("_gone"))
    gone = written(gone, "simhash-gone")
    return restore(rows.join(gone, F.col(ROW) == F.col("_gone"), "left_anti"))
