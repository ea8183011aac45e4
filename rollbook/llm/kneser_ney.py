"""Quality classifier: perplexity under a character n-gram model of trusted text.

An interpolated modified Kneser-Ney model of character 4-grams is counted on trusted documents: all
rows labelled with quality 1. By a hash of the id, four of five of them train, the fifth calibrates. The whole model is tables: counts per 4-gram,
continuation counts for the lower orders, discounts from the counts of counts, and per context the
mass left to the next lower order.

Documents are grouped into blocks. Their ids are joined with the trusted ones, and a block is told
which of its documents train; no text moves for that. A block's distinct 4-grams are joined with the
model (sharded by the 4-gram's code), and the probabilities come back to the block, which adds them
up per document. A document's log perplexity
is drawn towards its language's mean as if it had ``prior`` more characters, so that a few
characters decide nothing, and must not exceed its language's threshold: the ``upper`` quantile of the
calibrating documents of the language. So about that share of trusted text is kept. A language with fewer
than ``least`` calibrating documents takes the quantile of all.

Defined cases: a null or empty text is its end alone; null ``lang`` is a language; a null ``doc_id``
has no label; rows with equal ids are scored each; other columns are not read; without trusted rows
every document is kept; texts are read whole, a very long one is a block of its own; an empty table
gives an empty result. Characters beyond U+FFFF count as
one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import pack, pack_uint, unpack, unpack_uint, utf8
from rollbook.llm.shards import Kept, ids_in, ids_out
from rollbook.session import written

ORDER = 4
START, END = 2, 3
BITS = 16
_BLOCK = "block long, doc_ids binary, rows binary, langs array<string>, lengths binary, chars binary"


def codes(chars: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each character and at each text's end, text by text."""
    size = int(lengths.sum()) + ORDER * len(lengths)
    first = np.cumsum(lengths + ORDER) - (lengths + ORDER)
    padded = np.full(size, START, dtype=np.uint64)
    inside = np.ones(size, dtype=bool)
    for k in range(ORDER - 1):
        inside[first + k] = False
    ends = first + lengths + ORDER - 1
    real = inside.copy()
    inside[ends] = False
    padded[inside] = chars
    padded[ends] = END
    code = padded.copy()
    for k in range(1, ORDER):
        code[k:] |= padded[:-k] << np.uint64(BITS * k)
    return code[real].view(np.int64)


def _chars(text: bytes) -> np.ndarray:
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
    return np.minimum(points, 0xFFFF).astype("<u2")


def _blocks(docs: DataFrame, block_chars: int, kept: Kept, row_column: str | None = None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, number = TaskContext.get().partitionId() << 32, 0
        held, n = [], 0

        def row() -> pa.RecordBatch:
            chars = [h[2] for h in held]
            values = {
                "block": first + number,
                "doc_ids": ids_out(pa.array([h[0] for h in held], pa.int64())),
                "rows": ids_out(pa.array([h[3] for h in held], pa.int64())) if row_column else None,
                "langs": [h[1] for h in held],
                "lengths": pack_uint(np.array([len(c) for c in chars], dtype=np.int64)),
                "chars": pack(np.concatenate(chars)),
            }
            kinds = {"block": pa.int64(), "langs": pa.list_(pa.string())}
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kinds.get(k, pa.binary())) for k, v in values.items()], list(values)
            )

        for batch in batches:
            for doc_id, lang, text, *row_id in zip(*batch.columns, strict=True):
                held.append((doc_id.as_py(), lang.as_py(), _chars(text.as_py()), *[r.as_py() for r in row_id]))
                n += len(held[-1][2])
                if n >= block_chars:
                    yield row()
                    number, held, n = number + 1, [], 0
        if held:
            yield row()

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")]
    return kept.keep(docs.select(*columns, utf8().alias("text"), *([row_column] if row_column else [])).mapInArrow(run, _BLOCK), "quality_blocks")


def _training(blocks: DataFrame, trusted: DataFrame) -> DataFrame:
    """``block, trains``: the places in a block of its documents that train."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = ids_in(row["doc_ids"])
                block, place = np.full(len(ids), row["block"]), np.arange(len(ids), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(place), ids], ["block", "place", "doc_id"])

    ids = blocks.select("block", "doc_ids").mapInArrow(run, "block long, place int, doc_id long")
    training = ids.join(trusted.where("NOT calibrates"), F.col("doc_id") == F.col("_id"))
    return training.groupBy("block").agg(F.collect_list("place").alias("trains"))


def _grams(blocks: DataFrame, training: DataFrame, at_once: int = 1 << 16) -> DataFrame:
    """Per block its distinct 4-grams and how often its training documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = unpack_uint(row["lengths"])
                code = codes(unpack(row["chars"], "<u2"), lengths)
                trains = np.zeros(len(lengths), dtype=bool)
                trains[np.array(row["trains"] or [], dtype=np.int64)] = True
                known, count = np.unique(code[np.repeat(trains, lengths + 1)], return_counts=True)
                code.sort()
                distinct = code[np.concatenate([[True], code[1:] != code[:-1]])]
                n = np.zeros(len(distinct), dtype=np.int64)
                n[np.searchsorted(distinct, known)] = count
                for a in range(0, len(distinct), at_once):
                    part = distinct[a : a + at_once]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), row["block"])), pa.array(part), pa.array(n[a : a + at_once])],
                        ["block", "code", "n"],
                    )

    told = blocks.select("block", "lengths", "chars").join(training, "block", "left")
    return told.mapInArrow(run, "block long, code long, n long")


def _packed(answers: DataFrame, at_once: int = 1 << 20) -> DataFrame:
    """Rows of ``block, code, p`` as few rows of packed arrays: what goes to the blocks is a third.

    A task holds ``at_once`` rows, whatever the number of rows.
    """

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, code, p = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("block", "code", "p"))
        order = np.lexsort((code, block))
        block, code, p = block[order], code[order], p[order]
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        ends = np.concatenate([starts[1:], [len(block)]])
        packs = [
            # Sorted codes as steps, which take less room.
            (pack_uint(np.diff(code[a:b].view(np.uint64), prepend=np.uint64(0))), pack(p[a:b].astype("<f4")))
            for a, b in zip(starts, ends, strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[starts]), pa.array([x for x, _ in packs], pa.binary()), pa.array([x for _, x in packs], pa.binary())],
            ["block", "codes", "ps"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= at_once:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    return answers.select("block", "code", "p").mapInArrow(run, "block long, codes binary, ps binary")


def model_tables(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: ``code, alpha`` (what the order itself gives a gram) and ``context,
    gamma`` (the mass a context leaves to the next lower order). ``counts`` are ``code, c``."""
    tables = []
    level = counts
    for order in range(ORDER, 0, -1):
        level = written(level, f"quality-counts-{order}")
        few = level.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (few[f"n{k}"] for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        cut = [
            1 - 2 * y * n2 / n1 if n1 and n2 else 0.5,
            2 - 3 * y * n3 / n2 if n2 and n3 else 1.0,
            3 - 4 * y * n4 / n3 if n3 and n4 else 1.5,
        ]
        cut = [min(max(d, 0.05), k + 0.95) for k, d in enumerate(cut)]
        off = F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2])
        held = level.withColumn("context", F.shiftright("code", BITS) if order < ORDER else F.shiftrightunsigned("code", BITS))
        by_context = held.groupBy("context").agg(F.sum("c").alias("total"), F.sum(off).alias("cut"))
        alpha = held.join(by_context, "context").select("code", ((F.col("c") - off) / F.col("total")).alias("alpha"))
        gamma = by_context.select("context", (F.col("cut") / F.col("total")).alias("gamma"))
        tables.append((written(alpha, f"quality-alpha-{order}"), written(gamma, f"quality-gamma-{order}")))
        if order > 1:
            mask = (1 << BITS * (order - 1)) - 1
            shorter = F.col("code").bitwiseAND(F.lit(mask)).alias("code")
            # Continuations: in how many distinct longer grams the shorter one stands last.
            level = level.select(shorter).groupBy("code").agg(F.count(F.lit(1)).alias("c"))
    return tables[::-1]


def probabilities(distinct: DataFrame, tables: list[tuple[DataFrame, DataFrame]], alphabet: int) -> DataFrame:
    """``code, p`` for 4-grams: each order's share and the rest from the next lower one."""
    out = distinct.select("code")
    p = F.lit(1.0 / alphabet)
    for order, (alpha, gamma) in enumerate(tables, 1):
        mask = (1 << BITS * order) - 1
        gram = F.col("code") if order == ORDER else F.col("code").bitwiseAND(F.lit(mask))
        a = alpha.select(F.col("code").alias(f"g{order}"), F.col("alpha").alias(f"a{order}"))
        context = F.shiftrightunsigned(gram, BITS)
        g = gamma.select(F.col("context").alias(f"c{order}"), F.col("gamma").alias(f"m{order}"))
        out = out.join(a, gram == F.col(f"g{order}"), "left").join(g, context == F.col(f"c{order}"), "left")
        p = F.coalesce(f"a{order}", F.lit(0.0)) + F.coalesce(f"m{order}", F.lit(1.0)) * p
    # Single precision: seven digits of a probability, half the bytes on the way to the blocks.
    return out.select("code", p.cast("float").alias("p"))


def _scored(blocks: DataFrame, trusted: DataFrame, rows: list[str]) -> DataFrame:
    """``doc_id, lang, n_grams, total, calibrates`` (and the number in ``rows``) for every document of the blocks."""
    grams = written(_grams(blocks, _training(blocks, trusted)), "quality-grams")
    counts = grams.where("n > 0").groupBy("code").agg(F.sum("n").alias("c"))
    tables = model_tables(counts)
    alphabet = tables[0][0].count() + 1
    chances = written(probabilities(grams.select("code").distinct(), tables, alphabet), "quality-chances")
    answers = _packed(grams.select("block", "code").join(chances, "code"))

    def score(key: tuple, own: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        block = next(own.itertuples())
        lengths = unpack_uint(block.lengths)
        code = codes(unpack(block.chars, "<u2"), lengths)
        known = np.concatenate([np.cumsum(unpack_uint(c).view(np.uint64)).view(np.int64) for c in back["codes"]])
        logs = np.log10(np.concatenate([unpack(p, "<f4") for p in back["ps"]]).astype(np.float64))
        order = np.argsort(known)
        logs = logs[order][np.searchsorted(known[order], code)]
        # Every text has its end at least, so no two texts begin at one place.
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        numbers = {c: ids_in(block.rows).to_pandas() for c in rows}
        return pd.DataFrame({
            **numbers,
            "doc_id": ids_in(block.doc_ids).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get),
            "lang": list(block.langs),
            "n_grams": lengths + 1,
            "total": -np.add.reduceat(logs, starts),
        })

    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score, "".join(f"{c} long, " for c in rows) + "doc_id long, lang string, n_grams long, total double"
    )
    marked = scored.join(trusted, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    return written(marked.withColumn("calibrates", F.coalesce("calibrates", F.lit(False))), "quality-scored")


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    block_chars: int = 1 << 22,
    prior: int = 50,
    upper: float = 0.995,
    least: int = 30,
    row: str | None = None,
) -> DataFrame:
    """``doc_id, lang, n_grams, log_perplexity, threshold, kept`` (and the number ``row``) for every row of ``docs``."""
    rows = [row] if row else []
    if "lang" not in docs.columns:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    known = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("_id")).where("_id IS NOT NULL").distinct()
    known = written(known.withColumn("calibrates", F.pmod(F.xxhash64("_id"), F.lit(5)) == 4), "quality-trusted")
    with Kept(docs.sparkSession) as kept:
        scored = _scored(_blocks(docs, block_chars, kept, row), known, rows)
    held = scored.where("calibrates")
    mean = (F.sum("total") / F.sum("n_grams")).alias("mean")
    everywhere = held.agg(mean).first()["mean"] or 0.0
    means = held.groupBy("lang").agg(mean, F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    means = means.select(F.col("lang").alias("_l"), "mean")
    drawn = scored.join(means, F.col("lang").eqNullSafe(F.col("_l")), "left").drop("_l")
    middle = F.coalesce("mean", F.lit(everywhere))
    drawn = drawn.withColumn("log_perplexity", (F.col("total") + prior * middle) / (F.col("n_grams") + prior))
    held = drawn.where("calibrates")

    limit = F.percentile_approx("log_perplexity", upper, 10_000).alias("threshold")
    all_over = held.agg(limit).first()["threshold"]
    limits = held.groupBy("lang").agg(limit, F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    limits = limits.select(F.col("lang").alias("_l"), "threshold")
    out = drawn.join(limits, F.col("lang").eqNullSafe(F.col("_l")), "left")
    threshold = F.coalesce("threshold", F.lit(all_over if all_over is not None else float("inf")))
    return out.select(
        "doc_id", "lang", "n_grams", "log_perplexity", threshold.alias("threshold"),
        (F.col("log_perplexity") <= threshold).alias("kept"), *rows,
    )
