"""Intermediate results in the folder that every executor can reach."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


@dataclass
class _Run:
    """Where a run stages, whether it did, and the databases it made."""

    folder: str
    used: bool = False
    databases: list[str] = field(default_factory=list)


_runs: list[_Run] = []

log = logging.getLogger(__name__)


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, since there
    one machine holds the driver and all tasks.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="shelfpulse-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    if _runs:
        _runs[-1].used = True
        folder = _runs[-1].folder
    else:
        folder = f"{shared_root(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Gather what a run stages in one folder and delete it when the run is over.

    So are the scratch databases that it made. A process has one run at a time; results that
    outlive the run are written as tables or by ``kept``.
    """
    run = _Run(scratch_path(spark, "run"))
    _runs.append(run)
    try:
        yield run.folder
    finally:
        _runs.remove(run)
        for name in run.databases:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        if run.used:
            delete_folder(spark, run.folder)


def kept(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` gives, without the tables and folders that it made on the way.

    Only rows that depend on such are written; others come as they are.
    """
    path = scratch_path(spark, label)
    with staging(spark):
        out = make()
        if not _runs[-1].used:
            return out
        out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Py4JJavaError:
        # Left-over intermediate files cost space, not correctness.
        log.warning("could not delete %s", folder, exc_info=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a plan is consumed several times or feeds a table it also reads. The
    files outlive any executor, so a lost one costs a re-read and not a recompute.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose managed tables live below the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    if _runs:
        _runs[-1].databases.append(name)
    return name
