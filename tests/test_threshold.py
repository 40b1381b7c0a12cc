from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.functions import threshold


def test_whole_root(spark):
    rng = random.Random(1)
    roots = [0, 1, 2, 3, 10**9, 2**53, 10**18, 9 * 10**18 + 1]
    roots += [rng.randint(0, 10 ** rng.randint(1, 18)) for _ in range(500)]
    squares = sorted({max(r * r + d, 0) for r in roots for d in (-1, 0, 1, r, 2 * r, 2 * r + 1)})
    df = spark.createDataFrame([(Decimal(s),) for s in squares], "s decimal(38,0)")
    rows = threshold.with_whole_root(df, "s", "r").collect()
    assert [(int(x["s"]), int(x["r"])) for x in rows] == [(s, math.isqrt(s)) for s in squares]


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)", "decimal(9,0)", "decimal(20,6)"])
def test_units_there_and_back(spark, kind):
    df = spark.createDataFrame([("-12",), ("0",), ("7654321",)], "v string")
    df = df.select(F.col("v").cast(kind).alias("v"))
    data_type = df.schema["v"].dataType
    units = threshold.whole_units(F.col("v"), data_type)
    scale = data_type.scale if isinstance(data_type, T.DecimalType) else 0
    for row in df.select("v", units.alias("u"), threshold.from_units(units, data_type).alias("b")).collect():
        assert int(row["u"]) == int(row["v"]) * 10**scale
        assert row["b"] == row["v"]


def test_largest_below(spark):
    """Against exact integer arithmetic: t is below iff (n-1)(S-nt)^2 > nV and S > nt."""
    rng = random.Random(2)
    groups = [
        [rng.randint(-20, 10 ** rng.randint(1, 9)) for _ in range(rng.randint(2, 9))]
        for _ in range(400)
    ] + [[5, 5, 5], [1, 2, 3], [0, 0], [0, 480, 480, 480], [-3, -2, -1]]
    data = [(i, Decimal(len(g)), Decimal(sum(g)), Decimal(sum(x * x for x in g)))
            for i, g in enumerate(groups)]
    df = spark.createDataFrame(data, "i int, _n decimal(20,0), _sum decimal(38,0), _squares decimal(38,0)")
    for row in threshold.with_largest_below(df, "c").collect():
        g, c = groups[row["i"]], int(row["c"])
        size, total = len(g), sum(g)
        v = size * sum(x * x for x in g) - total * total

        def below(t):
            d = total - size * t
            return d > 0 and (size - 1) * d * d > size * v

        assert below(c) and not below(c + 1)
