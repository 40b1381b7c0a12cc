"""Period rows: one CSV per period, or a table partitioned by period."""

from __future__ import annotations

import codecs
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.checkpoints import store
from shiftgauge.functions.casts import exact_cast
from shiftgauge.schemas import DAY, MINUTES, PERIOD, PERIOD_ROWS, TEAM, USER
from shiftgauge.sources.partitions import replace_partitions

# File name of a period's rows and the text of a missing value.
_FILE = "t_analitika_{period}.csv"
_MISSING = "NA"

# No text is to be read as NULL by the CSV parser itself: it cannot tell a blank
# team from a missing one. A control character never occurs in the files.
_NEVER = "\u0001"


def period_path(root: str, period: str) -> str:
    return f"{root.rstrip('/')}/{_FILE.format(period=period)}"


def read_period(
    spark: SparkSession,
    root: str,
    period: str,
    *,
    day_type: str = "date",
    minutes_type: str = "decimal(18,2)",
    encoding: str = "UTF-8",
    multiline: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Read the rows of one period (a file or a folder of files with a header).

    ``NA`` is missing in every column. Blank text stays blank text, so a blank team
    is a team of its own; a blank number is missing. Days that are not plain ISO
    dates, and minutes that are no numbers or have more digits than
    ``minutes_type``, raise; pass ``day_type="string"`` to keep the day as written.
    Columns may come in any order and other columns are ignored. Rows with more or
    fewer fields than the header raise; with ``strict=False`` missing fields are blank
    and surplus ones dropped, and columns that are not used are not parsed. A record is one
    line, which keeps large files splittable; ``multiline`` allows line breaks in
    quoted text, at the price of one task per file.

    ``encoding`` is any that Python knows with one byte a character and ASCII below 128, such
    as ``windows-1250`` or ``ISO-8859-2``, or one with more bytes that Spark reads. Bytes that
    stand for nothing raise, since names that differ in such a letter only would become one.
    """
    table = one_byte_table(encoding)
    reader = spark.read.option("columnPruning", not strict)
    raw = reader.csv(
        period_path(root, period),
        header=True,
        enforceSchema=False,
        mode="FAILFAST" if strict else "PERMISSIVE",
        quote='"',
        escape='"',
        nullValue=_NEVER,
        encoding=encoding if table is None else "ISO-8859-1",
        multiLine=multiline,
    )
    raw = raw.select(*[_decoded(c, encoding, table) for c in raw.columns])
    day = _text(F.col(DAY))
    if day_type != "string":
        day = _iso_date(day)
    return raw.select(
        day.alias(DAY),
        _text(F.col(TEAM)).alias(TEAM),
        _text(F.col(USER)).alias(USER),
        _number(F.col(MINUTES), minutes_type).alias(MINUTES),
    )


def read_period_table(spark: SparkSession, path: str, period: str) -> DataFrame:
    """Read one period from a Parquet table partitioned by ``period``.

    A value that the schema cannot hold as it is raises, be it a number or text.
    """
    rows = spark.read.parquet(path).where(F.col(PERIOD) == period)
    return rows.select(*[exact_cast(rows, f) for f in PERIOD_ROWS.fields])


def write_period_table(
    rows: DataFrame,
    path: str,
    *,
    rows_per_file: int = 4_000_000,
    row_group_bytes: int = 64 * 1024 * 1024,
) -> None:
    """Write period rows (with a ``period`` column) as the table ``read_period_table`` reads.

    The periods that occur are replaced, others stay. Rows are range-sorted by period, team, day
    and user, so a period of any size is spread over as many tasks and files as it needs, a
    small one over few, and the row groups of other teams and days are skipped when one is
    read. No file has more than ``rows_per_file`` rows.
    """
    rows = rows.select(*[f.name for f in PERIOD_ROWS.fields], PERIOD)
    # Stored, as the ranges are sampled before the rows are sorted.
    rows, seen = store(rows, n=F.count(F.lit(1)))
    order = [PERIOD, TEAM, DAY, USER]
    # Ranges are cut by a sample, and a tenth more than wanted is usual.
    ranges = max(1, math.ceil(seen["n"] / (0.9 * rows_per_file)))
    replace_partitions(
        rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order),
        path,
        [PERIOD],
        **{"maxRecordsPerFile": str(rows_per_file), "parquet.block.size": str(row_group_bytes)},
    )


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def one_byte_table(encoding: str) -> dict[str, str | None] | None:
    """What the bytes from 128 on stand for (None: nothing), or None for other encodings.

    Such files are read byte by byte as ISO-8859-1, so every byte arrives, and then replaced.
    """
    python = codecs.lookup(encoding).name
    one = [_character(python, byte) for byte in range(256)]
    if [c for c in one[:128]] != [chr(b) for b in range(128)]:
        return None
    # Encodings of several bytes have bytes that are no character alone, and pairs that are one.
    pairs = [bytes([a, b]) for a in range(128, 256) for b in (0x40, 0x80, 0xA1, 0xBF)]
    if any(len(p.decode(python, "ignore")) == 1 and None in (one[p[0]], one[p[1]]) for p in pairs):
        if any(len(_character(python, p) or "") == 1 for p in pairs):
            return None
    return {chr(b): one[b] for b in range(128, 256)}


def _character(encoding: str, data: int | bytes) -> str | None:
    try:
        return (bytes([data]) if isinstance(data, int) else data).decode(encoding)
    except UnicodeDecodeError:
        return None


def _decoded(name: str, encoding: str, table: dict[str, str | None] | None) -> Column:
    text = _named(name)
    message = F.concat(F.lit(f"{name} is not {encoding}: "), text)
    refused = F.raise_error(message).cast("string")
    if table is None:
        return F.when(text.contains("\ufffd"), refused).otherwise(text).alias(name)
    made = {a: b for a, b in table.items() if b is not None and a != b}
    decoded = F.translate(text, "".join(made), "".join(made.values())) if made else text
    lost = "".join(a for a, b in table.items() if b is None)
    if lost:
        # Every lost byte is taken out, so the text is shorter if there was one.
        clean = F.length(F.translate(text, lost, "")) == F.length(text)
        decoded = F.when(text.isNull() | clean, decoded).otherwise(refused)
    return decoded.alias(name)


def _text(column: Column) -> Column:
    return F.when(column == _MISSING, F.lit(None)).otherwise(F.coalesce(column, F.lit("")))


def _iso_date(text: Column) -> Column:
    day = text.try_cast(T.DateType())
    plain = day.cast("string").eqNullSafe(text)
    return F.when(plain, day).otherwise(_reject(DAY, text, "date"))


def _number(column: Column, data_type: str) -> Column:
    text = F.trim(column)
    value = text.try_cast(data_type)
    # Compared in one type: a common type of two wide decimals may round.
    kept = text.try_cast("decimal(38,18)") == value.try_cast("decimal(38,18)")
    return (
        F.when((column == _MISSING) | (F.coalesce(text, F.lit("")) == ""), F.lit(None))
        .when(F.coalesce(kept, F.lit(False)), value)
        .otherwise(_reject(MINUTES, text, data_type))
    )


def _reject(name: str, text: Column, data_type: str) -> Column:
    message = F.concat(F.lit(f"{name} is not a {data_type}: "), F.coalesce(text, F.lit("")))
    return F.raise_error(message).cast(data_type)
