"""Exact percentiles by rank selection against numpy, on values of every shape."""

import decimal
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagewise import config as C
from stagewise.operators import ranks
from stagewise.operators.frequency import distribution, percentile_name


def want(values):
    x = sorted(float(v) for v in values if v is not None)
    if not x:
        return [None] * (3 + len(C.PERCENTILES))
    out = []
    for p in C.PERCENTILES:
        at = p * (len(x) - 1)
        low, high = x[math.floor(at)], x[math.ceil(at)]
        out.append(low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high)
    return [math.fsum(x) / len(x), x[0], *out, x[-1]]


def got(row):
    return [row["mean"], row["min"], *[row[percentile_name(p)] for p in C.PERCENTILES], row["max"]]


def alike(a, b):
    return all((x is None and y is None) or (x is not None and y is not None and (x == y or math.isclose(x, y, rel_tol=1e-12))) for x, y in zip(a, b, strict=True))


def groups():
    rng = random.Random(9)
    wide = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)]
    close = [1.0 + k * 2.0**-52 for k in range(300)]                       # neighbouring doubles
    tail = [rng.gauss(0, 1e-3) for _ in range(400)] + [1e12, -1e12]        # one bin holds nearly all
    return {"wide": wide, "close": close, "tail": tail, "one": [3.5], "same": [2.0] * 700, "two": [1.0, 2.0],
            "zeros": [0.0, -0.0, 0.0, 5e-324, -5e-324], "none": [None, None], None: [float(i) for i in range(101)] + [None]}


def test_doubles_by_group(spark):
    rows = [(g, v) for g, vs in groups().items() for v in vs]
    random.Random(1).shuffle(rows)
    out = {r["g"]: got(r) for r in distribution(spark.createDataFrame(rows, "g string, v double").repartition(7), "v", by=["g"]).collect()}
    assert set(out) == set(groups())
    for g, vs in groups().items():
        w = want(vs)
        assert alike(out[g][1:], w[1:]), g
        if g not in ("wide", "tail"):  # a sum of doubles that cancel
            assert (w[0] is None and out[g][0] is None) or math.isclose(out[g][0], w[0], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("ddl, make", [("v decimal(18,2)", lambda i: decimal.Decimal(i * 37 % 10007) / 100), ("v int", lambda i: i * 37 % 1009 - 500), ("v bigint", lambda i: (i * 37 % 10007) * 10**12)])
def test_exact_types_without_groups(spark, ddl, make):
    values = [make(i) for i in range(2500)] + [None] * 9
    row = distribution(spark.createDataFrame([(v,) for v in values], ddl), "v").first()
    assert row["variable"] == "v" and alike(got(row), want(values))


def test_two_dimensions_with_nulls(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1]), rng.choice([None, rng.uniform(-5, 5)])) for _ in range(3000)]
    out = {(r["g"], r["h"]): got(r) for r in distribution(spark.createDataFrame(rows, "g string, h int, v double"), "v", by=["g", "h"]).collect()}
    assert len(out) == 6
    for key, o in out.items():
        assert alike(o[1:], want([v for g, h, v in rows if (g, h) == key])[1:])


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert got(distribution(empty, "v").first()) == want([])
    assert distribution(empty, "v", by=["g"]).count() == 0


def test_special_doubles(spark):
    inf, nan = float("inf"), float("nan")
    row = distribution(spark.createDataFrame([(v,) for v in [-inf, -1.0, 0.0, 1.0, inf]], "v double"), "v").first()
    assert row["prcntl_25"] == -1.0 and row["prcntl_50"] == 0.0 and row["prcntl_75"] == 1.0
    row = distribution(spark.createDataFrame([(v,) for v in [1.0, 2.0, nan]], "v double"), "v").first()
    assert row["prcntl_50"] == 2.0 and math.isnan(row["max"])


def test_bins_never_fall(spark):
    rng = np.random.default_rng(5)
    x = np.unique(np.concatenate([rng.normal(0, s, 300) for s in (1e-320, 1e-9, 1.0, 1e9, 1e300)]))
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").orderBy("x").select(ranks.coarse_bin(F.col("x")).alias("b")).collect()
    bins = [r["b"] for r in rows]
    assert bins == sorted(bins) and max(map(abs, bins)) < 50_000


def test_no_group_state_in_a_task(spark):
    """No value map and no list of a group's values: hash aggregates, and windows over bins only."""
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = distribution(df, "v", by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan.lower().replace("prcntl", "") and "CartesianProduct" not in plan


def test_a_value_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.25).otherwise(F.col("id") / 16).alias("v"))
    values = [7.25 if i % 3 == 0 else i / 16 for i in range(30_000)]
    assert alike(got(distribution(df, "v").first()), want(values))
