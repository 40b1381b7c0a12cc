"""Input contracts: table names, columns and types."""

from __future__ import annotations

from pyspark.sql import types as T

# Table names of the source database. The users table has a "$"
# in its name and must be quoted in Spark SQL.
LOG_TABLE = "szlaforg_tetel_azon_log"
ITEMS_TABLE = "szlaforg_tetel_azon_mind"
USERS_TABLE = "U_USER_BASE$"

# The three-part key shared by the action log and the items.
ITEM_KEY = ["szlaforg_fej_azon", "forgtet_azon", "azon_forgtet_azon"]

# Grouping keys of the period rows (day, team, user).
DAY, TEAM, USER, MINUTES = "NAP", "F_KISCSOPORT", "F_NEV", "CKLIDO"

#: Partition column of the table of period rows.
PERIOD = "period"

LOG = T.StructType(
    [T.StructField("user_azon", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ITEM_KEY]
    + [
        T.StructField("azon_forgtet_mod_idopont", T.TimestampNTZType()),
        T.StructField("allapot_azon_feldolg", T.StringType()),
    ]
)

ITEMS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ITEM_KEY]
    + [
        T.StructField("ceg_szlaszam", T.DecimalType(38, 0)),
        T.StructField("forgtet_irany", T.StringType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_azon", T.StringType()),
        T.StructField("torzsszam", T.StringType()),
    ]
)

PERIOD_ROWS = T.StructType(
    [
        T.StructField(DAY, T.DateType()),
        T.StructField(TEAM, T.StringType()),
        T.StructField(USER, T.StringType()),
        T.StructField(MINUTES, T.DecimalType(18, 2)),
    ]
)
