"""Published tables: every write attempt makes a new version, a view of the plain name shows it.

Spark cannot overwrite a table it reads, and Parquet tables take no MERGE. So each attempt writes
a table or partition that no other attempt uses, and replacing the view is the one step that both
shows and records it. A failed attempt leaves the view and all it shows as they were. A repeated
run replaces what its earlier attempt wrote, also by nothing.

A run builds on the runs before it, so versions and histories move forward only: the last run may
be repeated, an older one or one with an earlier time is refused, because what came after it was
computed from it. Appended rows stand alone, so any of their runs may be repeated.

A table has one writer at a time. What dead attempts left behind goes with the next write.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from rollbook.operators.history import VERSION_COLUMNS, first_versions, is_open, next_versions
from rollbook.operators.layout import REFERENCE_DATE, RUN_ID, clustered
from rollbook.operators.upsert import upsert
from rollbook.session import tune

COMMITS = "rollbook.commits"
ATTEMPT = "_attempt"
SLICE = "_slice"
SLICES = "rollbook.slices"


class OutOfOrderError(ValueError):
    """A run that would be computed from the results of later ones."""


def checked_identifier(name: str) -> str:
    # Fixed value: the pattern of names that need no quoting.
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) is None:
        raise ValueError(f"{name!r} cannot be the name of a table or column: letters, digits and _ only")
    return name


class Commit(NamedTuple):
    """What the view's property records of a run: its attempt, its time, the release it loaded,
    and, of a table in slices, the slices it wrote."""

    run_id: str
    attempt: str
    moment: str = ""
    release: str = ""
    slices: str = ""

    @classmethod
    def new(cls, run_id: str, moment: datetime | None = None, release: str = "") -> Commit:
        for text in (run_id, release):
            if not re.fullmatch(r"[A-Za-z0-9_-]*", text):
                raise ValueError(f"{text!r} cannot be a run id or release: letters, digits, _ and - only")
        return cls(run_id, uuid.uuid4().hex[:12], moment.isoformat() if moment else "", release)

    def is_after(self, other: Commit) -> bool:
        if not (self.moment and other.moment):
            return True
        return datetime.fromisoformat(self.moment) > datetime.fromisoformat(other.moment)


@dataclass
class Warehouse:
    """The tables of one database.

    ``buckets`` stores the fact and the history bucketed by company, so that the next run's
    upsert and history join need not shuffle their stored side. They hold one live row per
    company. Tables with many rows per company, and those joined to them, are not bucketed: a hot
    company would fill one bucket, and adaptive execution splits only what it shuffled itself.

    Marts are sorted by their clustering columns inside each file, which costs no shuffle and
    lets readers skip row groups. ``cluster`` also range-partitions them along a curve through all
    clustering columns, one more shuffle per mart, so that a filter on any of them skips whole files.

    ``slices`` is the number of ranges of a company hash that a merged table is kept in: a run
    rewrites only those its batch changes. Some 100 MB a slice is a good size; a table stays with the
    number it began with.

    ``keep`` is the number of earlier runs whose versions stay readable, at least one; the attempt
    that a repeat replaces also stays until the next write. ``sample`` declares a database of
    samples, the only kind that takes runs with a row limit.
    """

    spark: SparkSession
    database: str
    buckets: int | None = None
    cluster: bool = False
    keep: int = 1
    sample: bool = False
    slices: int = 16

    def __post_init__(self) -> None:
        checked_identifier(self.database)
        if self.keep < 1:
            raise ValueError("the version before the last is needed to repeat a run: keep at least 1")
        tune(self.spark)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def full_name(self, name: str) -> str:
        return f"{self.database}.{checked_identifier(name)}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def publish(
        self,
        name: str,
        df: DataFrame,
        run_id: str,
        cluster_by: Sequence[str] = (),
        bucket_by: str | None = None,
        moment: datetime | None = None,
    ) -> DataFrame:
        """Write ``df`` as the version of ``run_id`` and point ``name`` to it."""
        commit = Commit.new(run_id, moment)
        before, shown = self._before(name, commit), self._commits(name)[-1:]
        if bucket_by and self.buckets:
            writer = (
                df.repartition(self.buckets, bucket_by)
                .write.bucketBy(self.buckets, bucket_by)
                .sortBy(*(cluster_by or (bucket_by,)))
            )
        elif cluster_by and self.cluster:
            writer = clustered(df, cluster_by, interleaved=True).write
        else:
            writer = (df.sortWithinPartitions(*cluster_by) if cluster_by else df).write
        version = self._version(name, commit)
        try:
            writer.format("parquet").saveAsTable(version)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
            raise
        kept = [*before[-self.keep :], commit]
        self._point(name, f"SELECT * FROM {version}", kept)
        stay = {self._version(name, c).split(".")[1] for c in (*kept, *shown)}
        for row in self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{name}__v_*'").collect():
            if row.tableName not in stay:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(row.tableName)}")
        return self.read(name)

    def version_before(
        self, name: str, run_id: str, moment: datetime | None = None
    ) -> DataFrame | None:
        """The version published by the run before ``run_id``, if there is one."""
        before = self._before(name, Commit.new(run_id, moment))
        return self.spark.table(self._version(name, before[-1])) if before else None

    def append(
        self, name: str, df: DataFrame, run_id: str, moment: datetime, release: str, sort_by: Sequence[str] = ()
    ) -> DataFrame:
        """Add a run's rows under its release and run id; the same run replaces its own rows."""
        commit = Commit.new(run_id, moment, release)
        commits = self._commits(name)
        now = [*(c for c in commits if c.run_id != run_id), commit]
        store = f"{name}__rows"
        self._add(store, df, commit, (REFERENCE_DATE, RUN_ID, ATTEMPT), sort_by=sort_by)
        columns = [c for c in self.read(store).columns if c != ATTEMPT]
        self._point(name, self._shown(store, columns, _is_one_of(now)), now)
        self._sweep(store, [*commits, *now])
        return self.read(name)

    def merge(
        self, name: str, batch: DataFrame, key: str, run_id: str, moment: datetime, sort_by: Sequence[str] = ()
    ) -> DataFrame:
        """Put a batch of one row per key into a table; only slices in which a row changes are rewritten.

        ``batch`` is read twice, so it should be written. A key the batch does not hold keeps its row;
        a NULL key is an error, before anything is shown.
        The table has the columns of the batch: a new one is NULL on rows that stay as they were, one
        that is gone is not shown. The other slices stay the partitions that earlier runs wrote and
        are shown by the view's filter, so the store grows by what changes. Of what is superseded,
        ``keep`` earlier states stay readable.
        """
        commit = Commit.new(run_id, moment)
        shown, before = self._commits(name), self._before(name, commit)
        store = f"{name}__slices"
        number = self._stored_slices(store) if before else self.slices
        unknown = F.raise_error(F.lit(f"{name}: a row has no {key}")).cast("int")
        place = F.when(F.col(key).isNull(), unknown).otherwise(F.pmod(F.xxhash64(key), F.lit(number)).cast("int"))
        sliced = batch.withColumn(SLICE, place)
        if before:
            was = self.read(store).filter(_shown_slices(_owners(before))).drop(ATTEMPT)
            touched = self._touched(was, sliced, key)
            there = F.col(SLICE).isin(touched)
            out = upsert(was.filter(there), sliced.filter(there), [key])
        else:
            touched, out = list(range(number)), sliced
        commit = commit._replace(slices=_as_ranges(touched))
        if touched:
            self._add(store, out.repartition(len(touched), SLICE), commit, (SLICE, ATTEMPT), sort_by=sort_by or (key,))
            if not before:
                self.spark.sql(f"ALTER TABLE {self.full_name(store)} SET TBLPROPERTIES ('{SLICES}' = '{number}')")
        now = [*before, commit]
        states = [_owners(now[: len(now) - back]) for back in range(min(self.keep + 1, len(now)))]
        used = {attempt for state in states for attempt in state.values()}
        now = [c for at, c in enumerate(now) if c.attempt in used or at >= len(now) - 1 - self.keep]
        self._point(name, self._shown(store, batch.columns, _shown_slices(_owners(now))), now)
        self._sweep_slices(store, [*states, _owners(shown)])
        return self.read(name)

    def _touched(self, was: DataFrame, now: DataFrame, key: str) -> list[int]:
        """The slices in which a row of the batch is new or differs: so many numbers at most."""
        kinds = {f.name: f.dataType for f in now.schema if f.name != SLICE}
        held = set(was.columns)
        old = F.struct(
            *((F.col(f"was.{c}") if c in held else F.lit(None).cast(kind)).alias(c) for c, kind in kinds.items())
        )
        new = F.struct(*(F.col(f"now.{c}").alias(c) for c in kinds))
        joined = now.alias("now").join(was.alias("was"), F.col(f"now.{key}").eqNullSafe(F.col(f"was.{key}")), "left")
        changed = joined.filter(F.col(f"was.{SLICE}").isNull() | ~new.eqNullSafe(old))
        return sorted(r[0] for r in changed.select(f"now.{SLICE}").distinct().collect())

    def _stored_slices(self, store: str) -> int:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(store)}").collect()
        return int(next(r.value for r in rows if r.key == SLICES))

    def _sweep_slices(self, store: str, states: Sequence[dict[int, str]]) -> None:
        """Drop the partitions that none of the states shows."""
        stay = {owned for state in states for owned in state.items()}
        table = self.full_name(store)
        for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect():
            values = dict(part.split("=", 1) for part in row.partition.split("/"))
            number, attempt = int(values[SLICE]), values[ATTEMPT]
            if (number, attempt) not in stay:
                self.spark.sql(
                    f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{SLICE}` = {number}, `{ATTEMPT}` = '{attempt}')"
                )

    def release_as_of(self, name: str, day: str) -> str:
        """The newest release of an appended table on or before a day; read from the view's record,
        so that a filter with it is a literal and only its partition is scanned."""
        known = [c.release for c in self._commits(name) if c.release <= day]
        if not known:
            raise ValueError(f"{name} has no release on or before {day}")
        return max(known)

    def last_appended(self, name: str) -> Commit:
        """The last run of the newest release in an appended table."""
        return max(self._commits(name), key=lambda c: (c.release, datetime.fromisoformat(c.moment)))

    def advance_history(
        self,
        name: str,
        source: DataFrame,
        key: str,
        compared: Sequence[str],
        run_id: str,
        run_time: datetime,
        sort_by: Sequence[str] = (),
    ) -> DataFrame:
        """Move a type 2 history on by one run.

        An attempt writes its open versions and the ones it closed as two partitions of its own,
        in one job, and reads nothing but the open partition of the run before. The view shows
        the open versions of the last run and the closed ones of every run, so closed history is
        never rewritten and an unfinished attempt is never seen.
        """
        commit = Commit.new(run_id, run_time)
        before, commits = self._before(name, commit), self._commits(name)
        store = f"{name}__versions"
        if before:
            was = self.read(store).filter(
                (F.col(ATTEMPT) == before[-1].attempt) & (F.col("state") == "open")
            )
            moved = next_versions(was.drop(ATTEMPT, "state"), source, key, compared, run_time)
        else:
            moved = first_versions(source, key, run_time)
        columns = (*source.columns, *VERSION_COLUMNS)
        state = F.when(is_open(), "open").otherwise("closed").alias("state")
        self._add(store, moved.select(*columns, state), commit, (ATTEMPT, "state"), key, sort_by)
        now = [*before, commit]
        shown = (
            f"(state = 'open' AND {_is_one_of([commit])}) OR (state = 'closed' AND {_is_one_of(now)})"
        )
        self._point(name, self._shown(store, columns, shown), now)
        self._sweep(store, [*commits, *now])
        return self.read(name)

    def _add(
        self,
        store: str,
        df: DataFrame,
        commit: Commit,
        partitions: Sequence[str],
        key: str = "",
        sort_by: Sequence[str] = (),
    ) -> None:
        """Add the attempt's partitions to a table of partitions, sorted in each file if asked."""
        df = df.withColumn(ATTEMPT, F.lit(commit.attempt))
        if sort_by:
            df = df.sortWithinPartitions(*partitions, *sort_by)
        table = self.full_name(store)
        if self.exists(store):
            # A new column is added before anything is written; one that is gone is NULL.
            fields = {f.name: f.dataType for f in self.spark.table(table).schema}
            added = [f"`{checked_identifier(f.name)}` {f.dataType.simpleString()}" for f in df.schema if f.name not in fields]
            if added:
                self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
                fields = {f.name: f.dataType for f in self.spark.table(table).schema}
            missing = {c: F.lit(None).cast(kind) for c, kind in fields.items() if c not in df.columns}
            df.withColumns(missing).select(*fields).write.insertInto(table)
            return
        writer: DataFrameWriter = df.write.format("parquet").partitionBy(*partitions)
        if key and self.buckets:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        try:
            writer.saveAsTable(table)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            raise

    def _shown(self, store: str, columns: Sequence[str], condition: str) -> str:
        names = ", ".join(f"`{c}`" for c in columns)
        return f"SELECT {names} FROM {self.full_name(store)} WHERE {condition}"

    def _sweep(self, store: str, commits: Sequence[Commit]) -> None:
        """Drop the partitions of attempts that neither are shown nor were until now."""
        stay = {c.attempt for c in commits}
        table = self.full_name(store)
        for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect():
            values = dict(part.split("=", 1) for part in row.partition.split("/"))
            if values[ATTEMPT] not in stay:
                spec = ", ".join(f"`{k}` = '{v}'" for k, v in values.items())
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")

    def _point(self, name: str, select: str, commits: Sequence[Commit]) -> None:
        recorded = ",".join("/".join(c) for c in commits)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.full_name(name)} "
            f"TBLPROPERTIES ('{COMMITS}' = '{recorded}') AS {select}"
        )
        self.spark.catalog.refreshTable(self.full_name(name))

    def _version(self, name: str, commit: Commit) -> str:
        run = commit.run_id.replace("-", "_").lower()
        return self.full_name(f"{name}__v_{run}_{commit.attempt}")

    def _commits(self, name: str) -> list[Commit]:
        """The runs a view shows or keeps, oldest first."""
        if not self.exists(name):
            return []
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(name)}").collect()
        recorded = next((r.value for r in rows if r.key == COMMITS), "")
        return [Commit(*c.split("/")) for c in recorded.split(",") if c]

    def _before(self, name: str, commit: Commit) -> list[Commit]:
        """The runs that come before that of ``commit``, which must be the last or a new one."""
        commits = self._commits(name)
        before = [c for c in commits if c.run_id != commit.run_id]
        if len(before) < len(commits) and commits[-1].run_id != commit.run_id:
            raise OutOfOrderError(
                f"{name}: {commits[-1].run_id} was built on {commit.run_id}, which can no longer be repeated"
            )
        if before and not commit.is_after(before[-1]):
            raise OutOfOrderError(
                f"{name}: {commit.run_id} at {commit.moment} is not after "
                f"{before[-1].run_id} at {before[-1].moment}"
            )
        return before


def _is_one_of(commits: Sequence[Commit]) -> str:
    return f"{ATTEMPT} IN ({', '.join(repr(c.attempt) for c in commits)})"


def _as_ranges(numbers: Sequence[int]) -> str:
    """Ascending numbers as text: ``0-3.7`` is 0, 1, 2, 3 and 7."""
    return ".".join(f"{a}-{b}" if a < b else f"{a}" for a, b in _ranges(numbers))


def _ranges(numbers: Sequence[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for n in numbers:
        if out and out[-1][1] == n - 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def _owners(commits: Sequence[Commit]) -> dict[int, str]:
    """The attempt that wrote each slice last."""
    owner: dict[int, str] = {}
    for commit in commits:
        for part in commit.slices.split("."):
            first, _, last = part.partition("-")
            if first:
                owner |= dict.fromkeys(range(int(first), int(last or first) + 1), commit.attempt)
    return owner


def _shown_slices(owner: dict[int, str]) -> str:
    """A condition on partition columns alone, so that no other partition is listed."""
    by_attempt: dict[str, list[int]] = {}
    for number in sorted(owner):
        by_attempt.setdefault(owner[number], []).append(number)
    shown = (
        f"({ATTEMPT} = '{attempt}' AND ({' OR '.join(f'{SLICE} BETWEEN {a} AND {b}' for a, b in _ranges(numbers))}))"
        for attempt, numbers in by_attempt.items()
    )
    return " OR ".join(shown) or "false"
