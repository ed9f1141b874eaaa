"""Frequency helpers and batteries: ordering, distributions, NULL months,
marginals and cohort sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stagewise.config import RunConfig
from stagewise.operators import frequency as Q

CFG = RunConfig()


def test_frequency_orders_nulls_last_and_extra_aggs(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("a", 3)], "k string, m int")
    rows = Q.frequency(df, ["k"], aggs=[F.count_distinct("m").alias("nm")]).collect()
    assert [(r["k"], r["n"], r["nm"]) for r in rows] == [("a", 2, 1), ("b", 1, 1), (None, 1, 1)]
    rows = Q.frequency(df, ["k"], where="m > 1", name="cnt").collect()
    assert [(r["k"], r["cnt"]) for r in rows] == [("a", 2), (None, 1)]


def test_count_where_and_distinct_values(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (3,)], "x int")
    assert Q.count_value(df) == 4
    assert Q.count_value(df, F.col("x") == 1) == 2
    assert Q.count_value(df, agg=F.count_distinct("x")) == 2
    assert Q.category_list(df, "x") == [1, 3, None]


def test_distribution_interpolates(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")
    r = Q.distribution(df, "x").first()
    assert r["variable"] == "x" and r["mean"] == 2.5 and r["min"] == 1 and r["max"] == 4
    assert r["prcntl_1"] == pytest.approx(1.03) and r["prcntl_25"] == pytest.approx(1.75)
    assert r["prcntl_50"] == pytest.approx(2.5) and r["prcntl_75"] == pytest.approx(3.25)


def test_distribution_by_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 10)], "g string, x int")
    got = {r["g"]: r["prcntl_50"] for r in Q.distribution(df, "x", by=["g"]).collect()}
    assert got == {"a": 2.0, "b": 10.0}


def test_monthly_counts_full_outer_semantics(spark):
    D = dt.date
    df = spark.createDataFrame([
        (D(1997, 1, 5), D(1997, 1, 9)), (D(1997, 2, 5), None), (None, None), (None, D(1997, 3, 1)),
    ], "ckd_stage_claims_date date, ckd_stage_jvhl_date date")
    got = [(r[0], r[1], r[2]) for r in Q.monthly_counts(df).collect()]
    assert got == [("199701", 1, 1), ("199702", 1, None), ("199703", None, 1), (None, 2, 2)]


@pytest.fixture(scope="module")
def final_flags(spark):
    from stagewise import DriverFixtures, StagingRun
    return StagingRun(DriverFixtures(spark, "/root/testdata/sf0.001"), CFG).final_flags.cache()


def test_one_way_tables_sum_to_population(final_flags):
    rows = Q.stage_frequencies(final_flags, CFG).collect()
    total = final_flags.count()
    for tid in {r["table_id"] for r in rows}:
        assert sum(r["n"] for r in rows if r["table_id"] == tid) == total


def test_crosstab_marginals_equal_one_way(final_flags):
    rows = Q.crosstab_battery(final_flags, CFG).collect()
    tables = Q.crosstab_tables(CFG, "TRUE", "TRUE")
    by_id = {t.table_id: t for t in tables}
    adults = final_flags.where("age >= 18").count()
    denom = final_flags.where("age >= 18 and jvhl_denom_flag = 1").count()
    for t in tables:
        n = sum(r["n"] for r in rows if r["table_id"] == t.table_id)
        assert n == (denom if "JVHL denominator" in t.title else adults), t.title
        if len(t.dims) > 1:
            one_way = next(o for o in tables if o.dims == (t.dims[0],) and o.title.endswith(
                t.title.split(" crosstab ")[1]))
            marg = {}
            for r in rows:
                if r["table_id"] == t.table_id:
                    marg[r["val1"]] = marg.get(r["val1"], 0) + r["n"]
            ow = {r["val1"]: r["n"] for r in rows if r["table_id"] == one_way.table_id}
            assert marg == ow, t.title
    assert len(by_id) == 30


def test_crosstab_keeps_null_values_distinct_from_missing_dims(final_flags):
    rows = Q.crosstab_battery(final_flags, CFG).collect()
    assert any(r["var2"] == "ckd_ccw_flag" and r["val2"] is None for r in rows)   # NULL flag kept
    assert all(r["var2"] is None for r in rows if r["title"].startswith("ckd_stage_jvhl for"))


def test_shared_report_cuboid_gives_same_tables(final_flags):
    base = Q.report_cuboid(final_flags, CFG)

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)
    assert rows(Q.stage_frequencies(final_flags, CFG)) == rows(Q.stage_frequencies(final_flags, CFG, base=base))
    assert rows(Q.crosstab_battery(final_flags, CFG)) == rows(Q.crosstab_battery(final_flags, CFG, base=base))
    assert base.count() < final_flags.count()
