"""Cutting lineage through storage that every executor can read again."""

from __future__ import annotations

import gc
import itertools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The paths that ``cut`` wrote within the innermost block of ``only``; None outside.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)
#: After so many written tables the driver collects its garbage: the plans and compiled classes of earlier ones.
TIDY = 8
_COUNT = itertools.count(1)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    ``spark.checkpoint.dir`` is taken where the cluster sets it. Where nothing is set, a local session, as in tests, gets a
    temporary folder of its machine; on a cluster, whose executors couldn't read that, it is an error.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = os.path.join(tempfile.mkdtemp(prefix="cartoria-"), "checkpoints")
    context.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder as a compressed table; later plans start from the written rows.

    The table can be read again by any executor after the loss of others. ``clear`` removes the tables of a session.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    if next(_COUNT) % TIDY == 0:
        gc.collect()  # else Python holds on to the JVM's plans
        spark.sparkContext._jvm.System.gc()
    return table


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """A block whose executions remove their shuffle files as each ends; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def only(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the other tables that ``cut`` wrote on the way are removed, and nothing else may read them."""
    outer, mine = _PASSING.get(), []
    token = _PASSING.set(mine)
    try:
        made = make()
        table = made if vars(made).get("_written") else cut(made)
    finally:
        _PASSING.reset(token)
    if table._written in mine:
        mine.remove(table._written)
        if outer is not None:
            outer.append(table._written)
    context = spark.sparkContext
    for path in map(context._jvm.org.apache.hadoop.fs.Path, mine):
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return table


def drop(*tables: DataFrame) -> None:
    """Removes tables that ``cut`` or ``only`` gave, before the session's others. Nothing may read them any more."""
    for table in tables:
        if table._written in (_PASSING.get() or []):
            _PASSING.get().remove(table._written)
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Removes all tables that ``cut`` wrote under this session's checkpoint folder. Nothing may read them any more."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    for status in files.globStatus(context._jvm.org.apache.hadoop.fs.Path(path, "cut-*")) or []:
        files.delete(status.getPath(), True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block at whose end all tables of ``cut`` are removed: build and write a query's rows inside."""
    try:
        yield
    finally:
        clear(spark)
