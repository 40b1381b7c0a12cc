"""Intermediate results kept in the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def checkpoint_folder(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting it on the context if needed.

    ``spark.checkpoint.dir`` wins. Where it is unset, a local session gets a folder
    of its own; a cluster session is an error, since a machine-local folder would
    be lost with the machine. A ``file:`` path is taken as named: a mounted network
    folder looks the same.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            context.setCheckpointDir(named)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="shiftgauge-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A new path below the checkpoint folder."""
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    kept = _SCOPE.get()
    if kept is not None:
        kept.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what the library stored within the ``with`` block.

    Frames made in the block are invalid after it: write or collect them before. Without a
    block, stored results stay until the folder is emptied. Blocks may be nested. What
    ``cut`` keeps is removed by Spark, where ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set.
    """
    token = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get()
        _SCOPE.reset(token)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            place = hadoop(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """Checkpoint ``df``: later reads and lost executors do not go back to its inputs.

    ``measures`` are aggregates taken while the rows pass by; their values are returned
    next to the frame. Partitions and their row order are kept. For large results use
    ``store``.
    """
    checkpoint_folder(df.sparkSession)
    df, values = _observed(df, measures)
    kept = df.checkpoint(eager=True)
    return kept, values()


def store(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """Like ``cut``, as a Parquet table: far smaller, and later reads take only their columns."""
    path = scratch_path(df.sparkSession)
    df, values = _observed(df, measures)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), values()


def _observed(df: DataFrame, measures: dict[str, Column]):
    if not measures:
        return df, dict
    observation = Observation()
    named = [column.alias(name) for name, column in measures.items()]
    return df.observe(observation, *named), lambda: observation.get
