"""Aggregates that are NULL as soon as one input is NULL.

Spark's aggregates skip NULLs. The work-hours rules do not: a missing value must
stay visible in the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_complete(column: Column, aggregate: Column) -> Column:
    """``aggregate``, or NULL if ``column`` is NULL in any row of the group."""
    return F.when(F.count(column) == F.count(F.lit(1)), aggregate)


def strict_sum(column: Column) -> Column:
    return if_complete(column, F.sum(column))


def strict_avg(column: Column) -> Column:
    return if_complete(column, F.avg(column))


def strict_stddev(column: Column) -> Column:
    """Sample standard deviation; NULL for a single value."""
    return if_complete(column, F.stddev_samp(column))
