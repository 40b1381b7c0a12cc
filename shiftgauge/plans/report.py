"""The numbered report of suspicious days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.operators.numbering import number_rows
from shiftgauge.schemas import TEAM, USER

# Report name and the text of a missing value.
_NAME = "Workhour_analysis_{period}"
_MISSING = "#N/A"


def report_path(root: str, period: str) -> str:
    return f"{root.rstrip('/')}/{_NAME.format(period=period)}"


def report_rows(days: DataFrame, collation: str | None = None) -> DataFrame:
    """Rows numbered from 1 by team and user, missing names last.

    Text is in binary order, or in that of ``collation``, one of Spark's: ``"hu"`` is the
    order of a Hungarian directory. Names that a collation holds equal are in binary order, so
    the numbering is the same whatever the partitions.
    """
    order = []
    for name in (TEAM, USER):
        if collation is not None:
            order.append(F.asc_nulls_last(F.collate(F.col(name), collation)))
        order.append(F.asc_nulls_last(name))
    return number_rows(days, order)


def write_report(
    days: DataFrame, root: str, period: str, fmt: str = "csv", collation: str | None = None
) -> str:
    """Write the report of a period, replacing an earlier one, and return its path.

    The part files are in row order. Missing values are spelled ``#N/A`` in CSV.
    """
    path = report_path(root, period)
    writer = report_rows(days, collation).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, nullValue=_MISSING)
    writer.format(fmt).save(path)
    return path
