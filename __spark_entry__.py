"""

The tables stand in for the inputs of the library:

* action log and items: ``events`` (key: event_id, user_id, event_type), users:
  the customers with a positive balance, so some users are unknown;
* period rows: ``lineitem`` by ship date, with the supplier as the user and either
  the supplier's region (small teams, some with one member) or the line status
  (large teams) as the team; or ``events`` by day, event type and user.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import shiftgauge as sg
from shiftgauge.checkpoints import scratch_path
from shiftgauge.functions.days import on_day
from shiftgauge.functions.text import number_to_text
from shiftgauge.operators.filters import in_users
from shiftgauge.plans.item_detail import join_items, join_users
from shiftgauge.plans.report import report_rows
from shiftgauge.schemas import DAY, ITEM_KEY, MINUTES, TEAM, USER, USERS
from shiftgauge.sources.periods import period_path



def _present(module: str) -> bool:
    try:
        return importlib.util.find_spec(module) is not None
    except ModuleNotFoundError:  # of a package above it
        return False


# The operators for training data may be left out as a whole; a broken one is an error.
corpus_pipeline = llm = None
if _present("corpus_pipeline") and _present("shiftgauge.llm.queries"):
    import corpus_pipeline
    from shiftgauge.llm import queries as llm

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the item queries: the reference day, the codes, and an IN list of
# the length the workload uses.
AS_OF, NEXT_DAY = "2024-01-16", "2024-01-17"
STATUS = "purchase"
ALLOWED = [str(user) for user in range(32)]
PERIOD, PERIOD_START, PERIOD_END = "1996H1", "1996-01-01", "1996-07-01"


# --- the tables as inputs of the library -------------------------------------------


# Schemas of the tables. Naming them saves a job per read to look them up.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_discount double, l_tax double, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_azon"),
        F.col("event_id").alias(ITEM_KEY[0]),
        F.col("user_id").alias(ITEM_KEY[1]),
        F.col("event_type").alias(ITEM_KEY[2]),
        F.col("event_type").alias("allapot_azon_feldolg"),
        F.col("ts").alias("azon_forgtet_mod_idopont"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias(ITEM_KEY[0]),
        F.col("user_id").alias(ITEM_KEY[1]),
        F.col("event_type").alias(ITEM_KEY[2]),
        F.col("event_id").cast("decimal(38,0)").alias("ceg_szlaszam"),
        F.when(F.col("value") >= 10, "J").otherwise("T").alias("forgtet_irany"),
    )


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return known.select(
        F.col("c_custkey").cast("string").alias("user_azon"), F.col("c_name").alias("torzsszam")
    )


def _allow_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return customers.select(F.col("c_custkey").cast("string").alias("user_azon"))


def _region_rows(spark: SparkSession, sf_dir: str, period: bool = False) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    if period:
        lines = lines.where(
            (F.col("l_shipdate") >= F.lit(PERIOD_START).cast("timestamp_ntz"))
            & (F.col("l_shipdate") < F.lit(PERIOD_END).cast("timestamp_ntz"))
        )
    suppliers = _table(spark, sf_dir, "supplier")
    nations = _table(spark, sf_dir, "nation")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .select(
            F.to_date("l_shipdate").alias(DAY),
            F.col("n_regionkey").cast("string").alias(TEAM),
            F.col("l_suppkey").cast("string").alias(USER),
            F.col("l_quantity").cast("bigint").alias(MINUTES),
        )
    )


def _status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias(DAY),
        F.col("l_linestatus").alias(TEAM),
        F.col("l_suppkey").cast("string").alias(USER),
        F.col("l_quantity").cast("bigint").alias(MINUTES),
        "l_discount",
        "l_tax",
    )


def _event_rows(spark: SparkSession, sf_dir: str, minutes: str = "decimal(18,2)") -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.to_date("ts").alias(DAY),
        F.col("event_type").alias(TEAM),
        F.col("user_id").cast("string").alias(USER),
        F.col("value").cast(minutes).alias(MINUTES),
    )


def _double_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir, "double")


# --- queries -----------------------------------------------------------------------


def _scan_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _region_rows(spark, sf_dir, period=True)


def _scan_period_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period rows of the whole events table, written as CSV and read by the reader."""
    root = scratch_path(spark)
    _event_rows(spark, sf_dir).write.csv(period_path(root, "2024H1"), header=True)
    return sg.read_period(spark, root, "2024H1")


def _scan_period_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half-year out of the table of half-years, written from all lines."""
    path = f"{scratch_path(spark)}/rows"
    half = F.when(F.month(DAY) <= 6, "H1").otherwise("H2")
    rows = _status_rows(spark, sf_dir).select(DAY, TEAM, USER, MINUTES)
    rows = rows.withColumn("period", F.concat(F.year(DAY).cast("string"), half))
    sg.write_period_table(rows, path)
    return sg.read_period_table(spark, path, PERIOD)


def _day_filter(offset_days: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        day = on_day(F.col("azon_forgtet_mod_idopont"), AS_OF, offset_days)
        return _log(spark, sf_dir).where(day)

    return run


def _status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).where(F.col("allapot_azon_feldolg") == STATUS)


def _direction_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).where(F.col("forgtet_irany") == "J")


def _in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_users(_log(spark, sf_dir), ALLOWED)


def _in_user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_users(_log(spark, sf_dir), _allow_table(spark, sf_dir))


def _inner_join_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_items(_log(spark, sf_dir), _items(spark, sf_dir))


def _fanout_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    left = lines.select(*keys, F.col("l_partkey").alias("left_part"))
    right = lines.select(*keys, F.col("l_partkey").alias("right_part"))
    return join_items(left, right, keys)


def _left_join_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_users(_log(spark, sf_dir), _users(spark, sf_dir))


def _number_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    kind = items.schema["ceg_szlaszam"].dataType
    account = number_to_text(F.col("ceg_szlaszam"), kind)
    return items.select(*ITEM_KEY, account.alias("ceg_szlaszam"))


def _fraction_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").cast("decimal(18,2)").alias("share")
    )
    text = number_to_text(F.col("share"), prices.schema["share"].dataType)
    return prices.select("l_orderkey", "l_linenumber", text.alias("share_text"))


def _item_detail(offset_days: int, table: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sg.processed_items(
            _log(spark, sf_dir),
            _items(spark, sf_dir),
            _users(spark, sf_dir),
            _allow_table(spark, sf_dir) if table else ALLOWED,
            as_of=AS_OF,
            offset_days=offset_days,
            status=STATUS,
        )

    return run


def _item_detail_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's items from stored tables: the status padded, unknown numbers blank."""
    root = scratch_path(spark)
    log, items = _log(spark, sf_dir), _items(spark, sf_dir)
    padded = F.rpad("allapot_azon_feldolg", 20, " ")
    log.withColumn("allapot_azon_feldolg", padded).write.parquet(f"{root}/log")
    items.write.parquet(f"{root}/items")
    number = F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise("").alias("torzsszam")
    customers = _table(spark, sf_dir, "customer")
    users = customers.select(F.col("c_custkey").cast("string").alias("user_azon"), number)
    users.write.parquet(f"{root}/users")
    return sg.processed_items(
        sg.read_relation(
            spark,
            f"{root}/log",
            T.StructType(log.schema.fields),
            blank_is_null=True,
            padded=["allapot_azon_feldolg"],
            only={"allapot_azon_feldolg": [STATUS], "user_azon": ALLOWED},
        ),
        sg.read_relation(spark, f"{root}/items", items.schema),
        sg.read_relation(spark, f"{root}/users", USERS, blank_is_null=True),
        ALLOWED,
        as_of=AS_OF,
        status=STATUS,
    )


def _on_rows(plan: Callable[[DataFrame], DataFrame], rows: Callable[..., DataFrame], **kwargs):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(rows(spark, sf_dir, **kwargs))

    return run


def _null_team_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _region_rows(spark, sf_dir)
    return rows.withColumn(TEAM, F.when(F.col(TEAM) != "0", F.col(TEAM)))


def _wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_rows(spark, sf_dir)
    return rows.withColumn(MINUTES, F.col(MINUTES).cast("decimal(38,18)"))


def _missing_minutes_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _status_rows(spark, sf_dir)
    lost = (F.col(MINUTES) == 50) & (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    return rows.withColumn(MINUTES, F.when(~lost, F.col(MINUTES)))


def _flag_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = sg.suspicious_flags(_double_rows(spark, sf_dir))
    return flags.select(DAY, TEAM, USER, "GYANUS_NAP")


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all events from a state built in deliveries: weeks, one of them twice, and late rows."""
    root, rows = scratch_path(spark), _event_rows(spark, sf_dir)
    week, late = F.pmod(F.weekofyear(DAY), F.lit(3)), F.crc32(F.col(USER).cast("binary")) % 10 == 0
    for part in (week == 0, week == 1, week == 0):
        sg.update_days(rows.where(part), root)
    sg.update_days(rows.where((week == 2) & ~late), root)
    sg.update_days(rows.where((week == 2) & late), root, add=True)
    return sg.count_days(spark, root)


def _items_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reference days of the item list, stored by day, the first of them run again."""
    path = f"{scratch_path(spark)}/items"
    for day in (AS_OF, NEXT_DAY, AS_OF):
        rows = sg.processed_items(
            _log(spark, sf_dir),
            _items(spark, sf_dir),
            _users(spark, sf_dir),
            ALLOWED,
            as_of=day,
            status=STATUS,
        )
        sg.write_items(rows, path, day)
    return sg.read_items(spark, path)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_rows(sg.suspicious_days(_status_rows(spark, sf_dir)))


def _report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as read back from the written file: every column is text."""
    days = sg.suspicious_days(_region_rows(spark, sf_dir))
    path = sg.write_report(days, scratch_path(spark), PERIOD)
    return spark.read.csv(path, header=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_period": _scan_period,
        "scan_period_csv": _scan_period_csv,
        "scan_period_table": _scan_period_table,
        "day_filter_offset1": _day_filter(1),
        "day_filter_offset3": _day_filter(3),
        "const_filter": _status_filter,
        "direction_filter": _direction_filter,
        "in_list": _in_list,
        "in_user_table": _in_user_table,
        "inner_join_3key": _inner_join_3key,
        "fanout_join": _fanout_join,
        "left_join_users": _left_join_users,
        "number_to_text": _number_to_text,
        "fraction_to_text": _fraction_to_text,
        "item_detail_d1": _item_detail(1),
        "item_detail_d3": _item_detail(3),
        "item_detail_user_table": _item_detail(1, table=True),
        "item_detail_tables": _item_detail_tables,
        "user_day_hours": _on_rows(sg.user_day_hours, _region_rows),
        "group_day_stats": _on_rows(sg.team_day_stats, _region_rows),
        "user_day_with_stats": _on_rows(sg.user_day_with_stats, _region_rows),
        "suspicious_flag": _on_rows(sg.suspicious_flags, _region_rows),
        "suspicious_days": _on_rows(sg.suspicious_days, _status_rows),
        "suspicious_days_period": _on_rows(sg.suspicious_days, _region_rows, period=True),
        "suspicious_days_null_group": _on_rows(sg.suspicious_days, _null_team_rows),
        "suspicious_days_missing": _on_rows(sg.suspicious_days, _missing_minutes_rows),
        "suspicious_days_events": _on_rows(sg.suspicious_days, _event_rows),
        "suspicious_flag_events": _on_rows(sg.suspicious_flags, _event_rows),
        "suspicious_flag_wide": _on_rows(sg.suspicious_flags, _wide_rows),
        "group_day_stats_wide": _on_rows(sg.team_day_stats, _wide_rows),
        "suspicious_flag_double": _flag_double,
        "suspicious_days_double": _on_rows(sg.suspicious_days, _double_rows),
        "suspicious_days_state": _state,
        "item_detail_by_day": _items_by_day,
        "report": _report,
        "report_file": _report_file,
    } | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}


def entry(spark: SparkSession) -> DataFrame:
    """Suspicious days per team and user over all events."""
    return queries()["suspicious_days_events"](spark, SMOKE_DIR)


# --- the same queries as SQL -------------------------------------------------------

_LOG_SQL = """
    SELECT CAST(user_id AS varchar) AS user_azon, event_id AS szlaforg_fej_azon,
           user_id AS forgtet_azon, event_type AS azon_forgtet_azon,
           event_type AS allapot_azon_feldolg, ts AS azon_forgtet_mod_idopont
    FROM events"""

_ITEMS_SQL = """
    SELECT event_id AS szlaforg_fej_azon, user_id AS forgtet_azon,
           event_type AS azon_forgtet_azon, CAST(event_id AS decimal(38,0)) AS ceg_szlaszam,
           CASE WHEN value >= 10 THEN 'J' ELSE 'T' END AS forgtet_irany
    FROM events"""

_USERS_SQL = """
    SELECT CAST(c_custkey AS varchar) AS user_azon, c_name AS torzsszam
    FROM customer WHERE c_acctbal > 0"""

_ALLOW_LIST_SQL = ", ".join(f"'{user}'" for user in ALLOWED)
_ALLOW_TABLE_SQL = (
    "SELECT CAST(c_custkey AS varchar) FROM customer WHERE c_mktsegment = 'BUILDING'"
)

_REGION_SQL = """
    SELECT CAST(l_shipdate AS date) AS nap, CAST(n_regionkey AS varchar) AS team,
           CAST(l_suppkey AS varchar) AS usr, CAST(l_quantity AS bigint) AS minutes
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey"""

_PERIOD_SQL = f"""{_REGION_SQL}
    WHERE l_shipdate >= TIMESTAMP '{PERIOD_START}' AND l_shipdate < TIMESTAMP '{PERIOD_END}'"""


def _status_sql(team: str = "l_linestatus", minutes: str = "CAST(l_quantity AS bigint)") -> str:
    return f"""
    SELECT CAST(l_shipdate AS date) AS nap, {team} AS team,
           CAST(l_suppkey AS varchar) AS usr, {minutes} AS minutes
    FROM lineitem"""


_EVENTS_SQL = """
    SELECT CAST(ts AS date) AS nap, event_type AS team, CAST(user_id AS varchar) AS usr,
           CAST(value AS decimal(18,2)) AS minutes
    FROM events"""


def _detail_sql(offset_days: int, allowed: str, as_of: str = AS_OF) -> str:
    return f"""
    WITH a AS ({_LOG_SQL}), b AS ({_ITEMS_SQL}), c AS ({_USERS_SQL})
    SELECT a.user_azon, c.torzsszam, a.szlaforg_fej_azon, a.forgtet_azon, a.azon_forgtet_azon,
           CAST(b.ceg_szlaszam AS varchar) AS ceg_szlaszam, a.azon_forgtet_mod_idopont AS datum
    FROM a JOIN b ON a.szlaforg_fej_azon = b.szlaforg_fej_azon
                 AND a.forgtet_azon = b.forgtet_azon
                 AND a.azon_forgtet_azon = b.azon_forgtet_azon
    LEFT JOIN c ON a.user_azon = c.user_azon
    WHERE CAST(a.azon_forgtet_mod_idopont AS date) = DATE '{as_of}' - {offset_days}
      AND a.allapot_azon_feldolg = '{STATUS}' AND b.forgtet_irany = 'J'
      AND a.user_azon IN ({allowed})"""


def _hours_sql(rows: str, units: int = 1) -> str:
    """Common tables: rows r, user-days d and u, team-days s, flags f, counts c.

    ``t`` is a whole number of units of 1/``units`` minute, so sums are exact; hours
    are made from exact sums, so their last bit does not depend on row order.
    """
    return f"""
    WITH r AS ({rows}),
    d AS (SELECT nap, team, usr,
                 CASE WHEN count(minutes) = count(*) THEN sum(minutes) END AS minutes
          FROM r GROUP BY nap, team, usr),
    u AS (SELECT *, CAST(minutes AS double) / 60 AS hours,
                 CAST(minutes * {units} AS hugeint) AS t FROM d),
    g AS (SELECT nap, team, CAST(count(*) AS hugeint) AS n,
                 CASE WHEN count(t) = count(*) THEN CAST(sum(t) AS hugeint) END AS total,
                 CASE WHEN count(t) = count(*) THEN CAST(sum(t * t) AS hugeint) END AS squares
          FROM u GROUP BY nap, team),
    s AS (SELECT *, CAST(total AS double) / CAST(n AS double) / {60.0 * units} AS mean_hours,
                 CASE WHEN n > 1 THEN
                      sqrt(CAST(n * squares - total * total AS double)
                           / CAST(n * (n - 1) AS double)) / {60.0 * units} END AS sd_hours
          FROM g),
    f AS (SELECT u.nap, u.team, u.usr, u.hours, s.mean_hours, s.sd_hours,
                 CASE WHEN s.total IS NOT NULL AND s.n > 1 THEN
                      s.total - s.n * u.t > 0
                      AND (s.n - 1) * (s.total - s.n * u.t) * (s.total - s.n * u.t)
                          > s.n * (s.n * s.squares - s.total * s.total) END AS flag
          FROM u LEFT JOIN s ON u.nap IS NOT DISTINCT FROM s.nap
                             AND u.team IS NOT DISTINCT FROM s.team),
    c AS (SELECT team, usr, CASE WHEN count(flag) = count(*) THEN
                 CAST(sum(CASE WHEN flag THEN 1 ELSE 0 END) AS bigint) END AS days
          FROM f GROUP BY team, usr)"""


_KEYS_SQL = 'nap AS "NAP", team AS "F_KISCSOPORT", usr AS "F_NEV"'
_HOURS_SQL = 'hours AS "MUNKAORA"'
_STATS_SQL = 'mean_hours AS "MUNKAORA_ATLAG", sd_hours AS "MUNKAORA_SZORAS"'


def _rows_sql(rows: str) -> str:
    return f'SELECT {_KEYS_SQL}, minutes AS "CKLIDO" FROM ({rows})'


def _flags_sql(rows: str, units: int = 1) -> str:
    return (
        f"{_hours_sql(rows, units)} SELECT {_KEYS_SQL}, {_HOURS_SQL}, {_STATS_SQL}, "
        'flag AS "GYANUS_NAP" FROM f'
    )


def _days_sql(rows: str, units: int = 1) -> str:
    return (
        f'{_hours_sql(rows, units)} SELECT team AS "F_KISCSOPORT", usr AS "F_NEV", '
        'days AS "GYANUS_NAPO_DB" FROM c'
    )


def _double_sql() -> str:
    """Flags f and counts c of floating-point minutes, exactly.

    Minutes are whole numbers of 2^-62. Squares are made of parts of 40 bits: h for the upper
    and l for the lower part, and sides of the comparison are compared by parts after carrying.
    """
    x = "CAST(1099511627776 AS hugeint)"
    split = "{0} // " + x + " - CASE WHEN {0} < 0 AND {0} % " + x + " <> 0 THEN 1 ELSE 0 END"
    return f"""
    WITH u AS (SELECT CAST(ts AS date) AS nap, event_type AS team, CAST(user_id AS varchar) AS usr,
                      sum(CAST(value * 4611686018427387904.0 AS hugeint)) AS t
               FROM events GROUP BY ALL),
    p AS (SELECT *, t // {x} AS h, t % {x} AS l FROM u),
    s AS (SELECT nap, team, CAST(count(*) AS hugeint) AS n, sum(t) AS total,
                 sum(h * h) AS q2, sum(2 * h * l) AS q1, sum(l * l) AS q0
          FROM p GROUP BY nap, team),
    v AS (SELECT nap, team, n, total, total // {x} AS h, total % {x} AS l,
                 q2, q1, q0 FROM s),
    r AS (SELECT nap, team, n, total, n * (n * q2 - h * h) AS r2, n * (n * q1 - 2 * h * l) AS r1,
                 n * (n * q0 - l * l) AS r0 FROM v),
    d AS (SELECT u.*, r.n, r2, r1, r0, r.total - r.n * u.t AS below FROM u JOIN r USING (nap, team)),
    e AS (SELECT *, greatest(below, 0) // {x} AS h, greatest(below, 0) % {x} AS l FROM d),
    w AS (SELECT *, (n - 1) * h * h - r2 AS c2, (n - 1) * 2 * h * l - r1 AS c1,
                 (n - 1) * l * l - r0 AS c0 FROM e),
    w1 AS (SELECT *, c1 + ({split.format("c0")}) AS d1,
                  c0 - ({split.format("c0")}) * {x} AS m0 FROM w),
    w2 AS (SELECT *, c2 + ({split.format("d1")}) AS d2,
                  d1 - ({split.format("d1")}) * {x} AS m1 FROM w1),
    f AS (SELECT nap, team, usr, CASE WHEN n > 1 THEN
                 below > 0 AND (d2 > 0 OR (d2 = 0 AND (m1 > 0 OR m0 > 0))) END AS flag FROM w2),
    c AS (SELECT team, usr, CASE WHEN count(flag) = count(*) THEN
                 CAST(sum(CASE WHEN flag THEN 1 ELSE 0 END) AS bigint) END AS days
          FROM f GROUP BY team, usr)"""


_NUMBER_SQL = "row_number() OVER (ORDER BY team ASC NULLS LAST, usr ASC NULLS LAST)"


def oracle_sql() -> dict[str, str]:
    day = "CAST(azon_forgtet_mod_idopont AS date)"
    lost = "l_quantity = 50 AND l_discount = 0.1 AND l_tax = 0.08"
    return {
        "scan_period": _rows_sql(_PERIOD_SQL),
        "scan_period_csv": _rows_sql(_EVENTS_SQL),
        "scan_period_table": f"""
            SELECT {_KEYS_SQL}, CAST(minutes AS decimal(18,2)) AS "CKLIDO"
            FROM ({_status_sql()})
            WHERE nap >= DATE '{PERIOD_START}' AND nap < DATE '{PERIOD_END}'""",
        "day_filter_offset1": f"SELECT * FROM ({_LOG_SQL}) WHERE {day} = DATE '{AS_OF}' - 1",
        "day_filter_offset3": f"SELECT * FROM ({_LOG_SQL}) WHERE {day} = DATE '{AS_OF}' - 3",
        "const_filter": f"SELECT * FROM ({_LOG_SQL}) WHERE allapot_azon_feldolg = '{STATUS}'",
        "direction_filter": f"SELECT * FROM ({_ITEMS_SQL}) WHERE forgtet_irany = 'J'",
        "in_list": f"SELECT * FROM ({_LOG_SQL}) WHERE user_azon IN ({_ALLOW_LIST_SQL})",
        "in_user_table": f"SELECT * FROM ({_LOG_SQL}) WHERE user_azon IN ({_ALLOW_TABLE_SQL})",
        "inner_join_3key": f"""
            SELECT a.*, b.ceg_szlaszam, b.forgtet_irany
            FROM ({_LOG_SQL}) a JOIN ({_ITEMS_SQL}) b
              ON a.szlaforg_fej_azon = b.szlaforg_fej_azon
             AND a.forgtet_azon = b.forgtet_azon
             AND a.azon_forgtet_azon = b.azon_forgtet_azon""",
        "fanout_join": """
            SELECT a.l_orderkey, a.l_linenumber, a.l_partkey AS left_part,
                   b.l_partkey AS right_part
            FROM lineitem a JOIN lineitem b
              ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""",
        "left_join_users": f"""
            SELECT a.*, c.torzsszam FROM ({_LOG_SQL}) a
            LEFT JOIN ({_USERS_SQL}) c ON a.user_azon = c.user_azon""",
        "number_to_text": f"""
            SELECT szlaforg_fej_azon, forgtet_azon, azon_forgtet_azon,
                   CAST(ceg_szlaszam AS varchar) AS ceg_szlaszam FROM ({_ITEMS_SQL})""",
        "fraction_to_text": """
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN l_discount = 0 THEN '0'
                        ELSE ltrim(rtrim(rtrim(CAST(CAST(l_discount AS decimal(18,2)) AS varchar),
                                               '0'), '.'), '0') END AS share_text
            FROM lineitem""",
        "item_detail_d1": _detail_sql(1, _ALLOW_LIST_SQL),
        "item_detail_d3": _detail_sql(3, _ALLOW_LIST_SQL),
        "item_detail_user_table": _detail_sql(1, _ALLOW_TABLE_SQL),
        "item_detail_tables": _detail_sql(1, _ALLOW_LIST_SQL),
        "user_day_hours": f"""{_hours_sql(_REGION_SQL)}
            SELECT {_KEYS_SQL}, {_HOURS_SQL} FROM u""",
        "group_day_stats": f"""{_hours_sql(_REGION_SQL)}
            SELECT nap AS "NAP", team AS "F_KISCSOPORT", {_STATS_SQL} FROM s""",
        "user_day_with_stats": f"""{_hours_sql(_REGION_SQL)}
            SELECT {_KEYS_SQL}, {_HOURS_SQL}, {_STATS_SQL} FROM f""",
        "suspicious_flag": _flags_sql(_REGION_SQL),
        "suspicious_days": _days_sql(_status_sql()),
        "suspicious_days_period": _days_sql(_PERIOD_SQL),
        "suspicious_days_null_group": _days_sql(
            _REGION_SQL.replace("CAST(n_regionkey AS varchar)", "CAST(nullif(n_regionkey, 0) AS varchar)")
        ),
        "suspicious_days_missing": _days_sql(
            _status_sql(minutes=f"CASE WHEN NOT ({lost}) THEN CAST(l_quantity AS bigint) END")
        ),
        "suspicious_days_events": _days_sql(_EVENTS_SQL, units=100),
        "suspicious_flag_events": _flags_sql(_EVENTS_SQL, units=100),
        "suspicious_flag_wide": _flags_sql(_EVENTS_SQL, units=100),
        "group_day_stats_wide": f"""{_hours_sql(_EVENTS_SQL, 100)}
            SELECT nap AS "NAP", team AS "F_KISCSOPORT", {_STATS_SQL} FROM s""",
        "suspicious_flag_double": f"""{_double_sql()}
            SELECT {_KEYS_SQL}, flag AS "GYANUS_NAP" FROM f""",
        "suspicious_days_double": f"""{_double_sql()}
            SELECT team AS "F_KISCSOPORT", usr AS "F_NEV", days AS "GYANUS_NAPO_DB" FROM c""",
        "suspicious_days_state": _days_sql(_EVENTS_SQL, units=100),
        "item_detail_by_day": " UNION ALL ".join(
            f"SELECT *, DATE '{day}' AS as_of, CAST(1 AS int) AS offset_days FROM ({_detail_sql(1, _ALLOW_LIST_SQL, day)})"
            for day in (AS_OF, NEXT_DAY)
        ),
        "report": f"""{_hours_sql(_status_sql())}
            SELECT {_NUMBER_SQL} AS row_no, team AS "F_KISCSOPORT", usr AS "F_NEV",
                   days AS "GYANUS_NAPO_DB" FROM c""",
        "report_file": f"""{_hours_sql(_REGION_SQL)}
            SELECT CAST({_NUMBER_SQL} AS varchar) AS row_no, team AS "F_KISCSOPORT",
                   usr AS "F_NEV", coalesce(CAST(days AS varchar), '#N/A') AS "GYANUS_NAPO_DB"
            FROM c""",
    } | _llm_sql()


def _llm_sql() -> dict[str, str]:
    if not llm:
        return {}
    whole = corpus_pipeline.ORACLE_SQL
    return llm.oracle_sql() | ({"pipeline": whole} if whole else {})
