"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot company is split even when that costs one more exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Staging projects many columns; beyond this size the JVM would interpret the generated
    # method instead of compiling it, so Spark is told to generate smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the plans rely on; safe to call on any session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; ``conf`` keys are Spark settings with dots written as ``__``."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return tune(builder.getOrCreate())


_local_folders: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine may go without the setting: it gets a folder that
    ends with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="rollbook-"))
        atexit.register(_local_folders[0].cleanup)
    return _local_folders[0].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and, unlike a checkpoint, stays columnar,
    so later readers scan only the columns they use.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concurrently[T](jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent jobs side by side, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in started.items()}


def all_written(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Write independent frames side by side; see ``written``."""
    return concurrently({name: lambda n=name, d=df: written(d, n) for name, df in frames.items()})
