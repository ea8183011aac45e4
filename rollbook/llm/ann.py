"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``sample`` rows, by the order of a hash of the id): k-means
splits every node into ``branch`` children until a leaf has about ``leaf_rows`` of all rows; its
nodes' centres are what is sent to the tasks, at most ``2 * sample`` vectors. Every row is put into
the leaf it reaches by the nearest child, so the index holds all rows.

A query walks the tree with a priority queue: it opens the nearest unopened node by the distance to its
centre, and each leaf it takes off the queue is visited. How many leaves to visit is calibrated:
sampled rows are searched exhaustively among the sample, and visits are widened until their mean
recall reaches ``recall``. Queries go to their leaves, the candidates' distances are taken in
double precision where the leaf's rows are, and the best of all leaves are merged by distance and
id. The leaves' rows are dealt in chunks of ``leaf_rows`` by a hash, so a leaf with a third of
all rows is many small groups.

Defined cases: null and zero vectors, those with null or non-finite components, and rows of a null
id take no part; vectors of another length than the most frequent one neither; of rows with equal
ids each counts; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.session import written


class Tree:
    """``centres`` of all nodes; ``children`` of inner ones; leaves are numbered."""

    def __init__(self, vectors: np.ndarray, leaf_size: int, branch: int, seed: int):
        self.centres, self.children, self.leaf_of = [], [], []
        self.leaves = 0
        self._grow(vectors, leaf_size, branch, np.random.default_rng(seed))
        self.centres = np.array(self.centres)

    def _grow(self, vectors: np.ndarray, leaf_size: int, branch: int, random: np.random.Generator) -> int:
        node = len(self.centres)
        self.centres.append(vectors.mean(axis=0))
        self.children.append([])
        self.leaf_of.append(-1)
        groups = _k_means(vectors, branch, random) if len(vectors) > leaf_size else None
        if groups is None or groups.max() == 0:
            self.leaf_of[node] = self.leaves
            self.leaves += 1
            return node
        for g in range(groups.max() + 1):
            self.children[node].append(self._grow(vectors[groups == g], leaf_size, branch, random))
        return node

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf_of[node] >= 0:
                out[rows] = self.leaf_of[node]
                continue
            children = np.array(self.children[node])
            nearest = _squares(vectors[rows], self.centres[children]).argmin(axis=1)
            todo += [(int(c), rows[nearest == k]) for k, c in enumerate(children)]
        return out

    def visits(self, vector: np.ndarray, n: int) -> list[int]:
        """The first ``n`` leaves, best bin first."""
        queue = [(0.0, 0)]
        out = []
        while queue and len(out) < n:
            _, node = heapq.heappop(queue)
            if self.leaf_of[node] >= 0:
                out.append(self.leaf_of[node])
                continue
            children = self.children[node]
            far = ((self.centres[children] - vector) ** 2).sum(axis=1)
            for distance, child in zip(far.tolist(), children, strict=True):
                heapq.heappush(queue, (distance, child))
        return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :]


def _k_means(vectors: np.ndarray, k: int, random: np.random.Generator, steps: int = 8) -> np.ndarray | None:
    distinct = np.unique(vectors, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[random.permutation(len(distinct))[:k]]
    for _ in range(steps):
        groups = _squares(vectors, centres).argmin(axis=1)
        sizes = np.bincount(groups, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, groups, vectors)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    groups = _squares(vectors, centres).argmin(axis=1)
    return np.unique(groups, return_inverse=True)[1]


def usable(vector: str = "embedding") -> Column:
    """Not null, finite in every component, and not zero."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def calibrated(tree: Tree, vectors: np.ndarray, k: int, recall: float, queries: int) -> int:
    """Leaves to visit for the recall asked, measured among the sampled vectors."""
    leaf = tree.assign(vectors)
    tried = np.linspace(0, len(vectors) - 1, min(queries, len(vectors))).astype(int)
    needed = np.zeros((len(tried), tree.leaves))
    for row, q in enumerate(tried):
        distance = ((vectors - vectors[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        truth = np.argsort(distance, kind="stable")[: min(k, len(vectors) - 1)]
        order = {leaf_number: at for at, leaf_number in enumerate(tree.visits(vectors[q], tree.leaves))}
        for t in truth:
            needed[row, order[leaf[t]]] += 1 / max(1, len(truth))
    found = np.cumsum(needed.mean(axis=0))
    return int(np.searchsorted(found, min(recall, found[-1]) - 1e-12)) + 1


def nearest(
    rows: DataFrame,
    queries: Column,
    k: int = 10,
    sample: int = 10_000,
    branch: int = 16,
    leaf_rows: int = 500,
    recall: float = 0.97,
    calibrating: int = 300,
    seed: int = 5,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``queries`` holds."""
    vectors = rows.where(usable() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda v: v.cast("double")).alias("embedding"),
        queries.alias("asks"),
    )
    sizes = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return rows.sparkSession.createDataFrame([], schema)
    vectors = vectors.where(F.size("embedding") == sizes["d"])
    total = sizes["count"]
    taken = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toPandas()
    fitted = _matrix(taken["embedding"])
    # A leaf of the sample stands for ``leaf_rows`` of all rows, but for 8 of the sample at least.
    tree = Tree(fitted, max(8, math.ceil(leaf_rows * len(fitted) / total)), branch, seed)
    visits = calibrated(tree, fitted, k, recall, calibrating)
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=shared.value.assign(_matrix(batch["embedding"])))

    placed = vectors.mapInPandas(place, "vec_id long, embedding array<double>, asks boolean, leaf long")
    # Ids may repeat, so rows are told apart by a written number.
    placed = written(placed.withColumn("row", F.monotonically_increasing_id()), "ann-leaves")
    # A leaf's chunks hold leaf_rows rows each.
    chunks = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / leaf_rows).cast("int").alias("chunks"))
    chunks = written(chunks, "ann-chunks")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (r, q, v, leaf)
                for r, q, v in zip(batch["row"], batch["vec_id"], batch["embedding"], strict=True)
                for leaf in shared.value.visits(np.asarray(v), visits)
            ]
            yield pd.DataFrame(out, columns=["query_row", "query_id", "embedding", "leaf"])

    asked = placed.where("asks").select("row", "vec_id", "embedding").mapInPandas(
        ask, "query_row long, query_id long, embedding array<double>, leaf long"
    )
    asked = written(asked, "ann-asked")
    # The queries of a leaf are dealt into slices of leaf_rows, each of which meets all its chunks.
    slices = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / leaf_rows).cast("int").alias("slices"))
    groups = written(chunks.join(slices, "leaf"), "ann-groups")
    asked = asked.join(groups, "leaf").select(
        "query_row", "query_id", "embedding", "leaf",
        F.pmod(F.xxhash64("query_row"), "slices").cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    there = placed.join(groups, "leaf").select(
        "row", "vec_id", "embedding", "leaf", F.pmod(F.xxhash64("row"), "chunks").cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
    )

    def search(key: tuple, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asking):
            own = own.sort_values(["vec_id", "row"])
            numbers, ids, matrix = own["row"].to_numpy(), own["vec_id"].to_numpy(), _matrix(own["embedding"])
            for r, q, v in zip(asking["query_row"], asking["query_id"], asking["embedding"], strict=True):
                score = np.sqrt(((matrix - np.asarray(v)) ** 2).sum(axis=1))
                score[numbers == r] = np.inf
                best = np.argsort(score, kind="stable")[:k]
                out += [(r, q, int(numbers[b]), int(ids[b]), float(score[b])) for b in best if np.isfinite(score[b])]
        return pd.DataFrame(out, columns=["query_row", "query_id", "row", "vec_id", "score"])

    keys = ("leaf", "chunk", "slice")
    found = there.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        search, "query_row long, query_id long, row long, vec_id long, score double"
    )
    rank = F.expr("row_number() OVER (PARTITION BY query_row ORDER BY score, vec_id, row)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
