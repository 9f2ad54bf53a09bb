"""Session set-up and the shared folder used for intermediate tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)
#: By application: writes under way, and the caller's setting.
_writing: dict[str, tuple[int, str]] = {}
_writing_lock = Lock()


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package expects; `settings` override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below `spark.checkpoint.dir`, which every executor can read."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/cartwright-{spark.sparkContext.applicationId}"


def dataset_dir(spark: SparkSession, source: str) -> str:
    """A folder in the shared area that belongs to one source data set."""
    return f"{shared_dir(spark)}/{hashlib.md5(source.encode()).hexdigest()[:12]}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared area."""
    return f"{shared_dir(spark)}/scratch/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Executions that begin inside delete their shuffle files when they end, not when the driver's heap is cleaned.

    The caller's setting comes back when the last of several threads leaves.
    """
    app = spark.sparkContext.applicationId
    with _writing_lock:
        count, before = _writing.get(app) or (0, spark.conf.get(SHUFFLE_CLEANUP, "false"))
        _writing[app] = (count + 1, before)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing_lock:
            count, before = _writing.pop(app)
            if count > 1:
                _writing[app] = (count - 1, before)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def write_once(df: DataFrame, path: str) -> None:
    """Writes a new parquet folder; the shuffle files that this takes are deleted at the end."""
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write `df` once to the shared area and read it back.

    Inside `scratch_scope` the copy is deleted at the end of the scope, otherwise it stays as long as the folder.
    """
    path = scratch_path(df.sparkSession, label)
    write_once(df, path)
    if (held := _written.get()) is not None:
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what `materialise` writes inside; use it around the writing of a result."""
    held: list[str] = []
    token = _written.set(held)
    try:
        yield
    finally:
        _written.reset(token)
        for path in held:
            delete_path(spark, path)


def materialise_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """Like `materialise` for the result of `build`; what `build` itself materialised is deleted."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        df = build()
        write_once(df, path)
    if (held := _written.get()) is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(*actions: Callable[[], object]) -> list:
    """Runs the actions at the same time, within the caller's scratch scope; results in order."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, action) for action in actions]]


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at `path` with the columns of all its files, None if nothing is there."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
