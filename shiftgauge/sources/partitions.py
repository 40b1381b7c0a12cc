"""Parquet tables of which single partitions are replaced."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F



def replace_partitions(
    df: DataFrame,
    path: str,
    by: list[str],
    expected: Iterable[tuple] = (),
    **options: str,
) -> None:
    """Replace the partitions that ``df`` has rows in; others stay as they are.

    New files are complete before any of the old ones go, so a failed run leaves the table as it
    was. ``expected`` names partitions that are to be replaced even if ``df`` has no rows in
    them: these are emptied. ``df`` must not read the table itself; see ``stored_partitions``.
    """
    expected = list(expected)
    observation = Observation()
    if expected:
        rows = [F.count(F.when(_is(by, values), 1)).alias(str(i)) for i, values in enumerate(expected)]
        df = df.observe(observation, *rows)
    writer = df.write.mode("overwrite").partitionBy(*by).options(**options)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    if expected:
        for i, values in enumerate(expected):
            if not observation.get[str(i)]:
                _drop(df.sparkSession, path, by, values)


def stored_partitions(spark: SparkSession, path: str) -> bool:
    """Is there a table at ``path`` yet?"""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(place) and any("=" in s.getPath().getName() for s in files.listStatus(place))


def _is(by: list[str], values: tuple) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(by, values, strict=True)],
    )


def _drop(spark: SparkSession, path: str, by: list[str], values: tuple) -> None:
    """Delete one partition; values are days, numbers or plain words, which need no escaping."""
    parts = []
    for name, value in zip(by, values, strict=True):
        text = value.isoformat() if isinstance(value, datetime.date) else str(value)
        if not text.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a partition cannot be named by {text!r}")
        parts.append(f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else text}")
    place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
