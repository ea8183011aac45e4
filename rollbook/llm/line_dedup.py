"""Dropping the lines that many documents share, found through levelled sorted runs.

The documents' line keys are hashed (two 64-bit hashes, 128 bits together) and dealt into batches.
A store of *runs* counts in how many documents a key was seen: a run is a table sorted by hash with
one row per key. A new batch is counted, merge-anti-joined with the keys the runs already settled
(those at ``min_docs``; nothing more has to be known of them), and what remains is added as a run of
level 0. When a level holds ``fanout`` runs they are merged, counts added, into one run of the next
level. After the last batch the keys at ``min_docs`` or more are those whose lines go. Counting is
exact: no key is sampled, capped or dropped before it is settled.

Runs are written tables, so a lost executor costs a task, and a store can be kept and fed again
(``LineStore``).

Defined cases: a null or empty text is one empty line; keys shorter than ``min_length`` code points
never go; rows with equal ``doc_id`` (null too) count as one document but are each filtered; other
columns pass through whatever their names, except that ones named like a result are replaced; a very long
text is one row like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rollbook.llm.common import SPACE_CLASS, lower_ascii, sheltered
from rollbook.session import written

SLOTS = 256
_KEY = ["h1", "h2"]
_RUN = StructType([StructField(n, LongType()) for n in ("h1", "h2", "n")])


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def key_of(line: Column) -> Column:
    return lower_ascii(F.regexp_replace(line, f"^{SPACE_CLASS}+|{SPACE_CLASS}+\\z", ""))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


class LineStore:
    """Levels of sorted runs of line keys with the number of documents that hold them."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 3):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], _RUN)
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        return both.groupBy(*_KEY).agg(F.sum("n").alias("n"))

    def settled(self) -> DataFrame:
        """The keys found in ``min_docs`` documents or more."""
        runs = [run for level in self.levels for run in level]
        return self._merged(runs).where(F.col("n") >= self.min_docs)

    def add(self, counted: DataFrame) -> None:
        """Take a batch of ``h1, h2, n`` whose documents no earlier batch held."""
        if any(self.levels):
            counted = counted.join(self.settled().select(*_KEY).hint("merge"), _KEY, "left_anti")
        self.levels[0].append(self._run(counted))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._run(self._merged(self.levels[level])))
            self.levels[level] = []
            level += 1

    def _run(self, rows: DataFrame) -> DataFrame:
        return written(rows.select(*_KEY, "n").sortWithinPartitions(*_KEY), "line-run")


def line_keys(docs: DataFrame, min_length: int) -> DataFrame:
    """``doc_id`` and its distinct line keys as an array of hashes."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), key_of))
    long_enough = F.filter(keys, lambda k: F.length(k) >= min_length)
    return docs.select("doc_id", F.transform(long_enough, _hashes).alias("keys"))


def _slots(shared: Column) -> Column:
    """Many keys dealt into slots by hash, so that one lookup searches a small part of them."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)),
        lambda s: F.filter(shared, lambda k: F.pmod(k["h1"], F.lit(SLOTS)) == s),
    )


def _in_slots(key: Column) -> Column:
    slot = F.pmod(key["h1"], F.lit(SLOTS)).cast("int")
    return F.array_contains(F.get("_slots", slot), key)


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_length: int = 1, batches: int = 4, fanout: int = 3
) -> DataFrame:
    """``docs`` with the remaining text, ``n_lines`` before dropping, and ``n_dropped``."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    pairs = line_keys(docs, min_length).select(batch.alias("batch"), "doc_id", F.explode("keys").alias("key"))
    # A document may stand in several rows, so its pairs are made distinct; lines are few against
    # words, and the pairs carry three numbers each.
    pairs = written(
        pairs.select("batch", "doc_id", "key.h1", "key.h2").distinct(), "line-pairs"
    )
    store = LineStore(spark, min_docs, fanout)
    for number in range(batches):
        counted = pairs.where(F.col("batch") == number).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
        store.add(counted)
    shared = written(store.settled().select(*_KEY), "line-settled")
    # For each document that holds such keys, the keys; the texts are shuffled once at most.
    found = (
        pairs.join(shared, _KEY, "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct(*_KEY)).alias("_shared"))
    )
    slim, restore = sheltered(docs, "doc_id", "text")
    kept = slim.columns
    left = slim.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), "left")
    lines = F.col("_lines")
    # Line breaks inside documents without shared lines stay untouched, and cost nothing more.
    rest = (
        F.when(F.col("_shared").isNull(), lines)
        .when(F.size("_shared") <= 64, F.filter(lines, lambda x: ~F.array_contains("_shared", _hashes(key_of(x)))))
        .otherwise(F.filter(lines, lambda x: ~_in_slots(_hashes(key_of(x)))))
    )
    step = left.select(*[F.col(f"d.{c}") for c in kept], "_shared", lines_of(F.col("d.text")).alias("_lines"))
    step = step.withColumn("_slots", F.when(F.size("_shared") > 64, _slots(F.col("_shared"))))
    step = step.withColumn("_rest", rest)
    out = step.select(
        *[c for c in kept if c != "text"],
        F.array_join("_rest", "\n").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_rest")).cast("long").alias("n_dropped"),
    )
    return restore(out, "n_lines", "n_dropped")
