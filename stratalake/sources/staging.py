"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.files import delete_folder

_local_folders: dict[str, str] = {}
_of_load: ContextVar[list[str] | None] = ContextVar("staged_by_load", default=None)

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict[str, tuple[int, str | None]] = {}
_dropping_lock = Lock()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own: a
    cluster has to name one that survives the loss of an executor.
    """
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="stratalake-")
        shared = _local_folders[application]
    return f"{shared.rstrip('/')}/stratalake/{application}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call returns."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs in this block go when their job ends, not when the driver next collects garbage.

    The setting is the session's; of blocks that overlap the last one puts it back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        depth, before = _dropping.get(session) or (0, spark.conf.get(_DROP_SHUFFLES, None))
        _dropping[session] = depth + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            depth, before = _dropping.pop(session)
            if depth > 1:
                _dropping[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


@contextmanager
def staged_for_load(spark: SparkSession) -> Iterator[None]:
    """What is staged in this block, or in threads it starts with its context, goes when the block ends.

    For loads that write their result: a frame made in the block cannot be read
    after it. A block inside another leaves its tables to the outer one. Shuffle
    files go earlier, each job's when it ends.
    """
    if _of_load.get() is not None:
        yield
        return
    paths: list[str] = []
    token = _of_load.set(paths)
    try:
        with shuffles_dropped(spark):
            yield
    finally:
        _of_load.reset(token)
        for path in paths:
            delete_folder(spark, path)


def stage(rows: DataFrame, label: str = "staged", codec: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``rows`` once and read them back.

    Cuts lineage where an input is used several times: later readers scan only
    the columns they need, the optimizer sees the real size, and the data
    outlives the executors that made it. ``codec`` compresses the files,
    otherwise the session's does. With ``by`` the files lie apart by that
    column, so that a reader of some of its values opens only theirs.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    paths = _of_load.get()
    if paths is not None:
        paths.append(path)
    rows.write.parquet(path, compression=codec, partitionBy=by)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
