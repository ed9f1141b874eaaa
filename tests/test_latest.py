"""Latest-per-key and the unspecified-stage-3 refinement against naive forms
(self-join to the per-key maximum), including NULL keys, NULL dates and ties."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stagewise.config import RunConfig
from stagewise.operators import diagnoses, labs
from stagewise.operators.latest import latest_by


def _d(i):
    return dt.date(1997, 1, 1) + dt.timedelta(days=i)


def _rows_equal(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def _dx_frame(spark, seed=7, n=600):
    rnd = random.Random(seed)
    nums = [1810, 1820, 1830, 1831, 1832, 1840, 1850]
    rows = []
    for _ in range(n):
        m = rnd.choice([None] + list(range(1, 40)))
        d = None if rnd.random() < 0.08 else _d(rnd.randrange(0, 30))
        rows.append((m, rnd.randrange(1, 10 ** 6), "x", d, rnd.choice(nums)))
    return spark.createDataFrame(rows, "member_id long, claim_id long, dx_code string, from_date date, dx_num int")


def _naive_latest(dx):
    mx = dx.groupBy("member_id").agg(F.max("from_date").alias("max_date"))
    j = dx.alias("b").join(mx.alias("a"), (F.col("a.member_id") == F.col("b.member_id"))
                           & (F.col("a.max_date") == F.col("b.from_date")))
    return j.groupBy(F.col("a.member_id").alias("member_id"), F.col("b.from_date").alias("from_date")) \
            .agg(F.max("b.dx_num").alias("dx_num"))


def _naive_final(dx):
    latest = _naive_latest(dx)
    spec_rows = (latest.where(F.col("dx_num") == 1830).select("member_id").alias("a")
                 .join(dx.alias("b"), "member_id").where(F.col("b.dx_num").isin(1831, 1832))
                 .select("member_id", "b.dx_num", "b.from_date"))
    s3date = spec_rows.groupBy("member_id").agg(F.max("from_date").alias("max_date"))
    s3 = (s3date.alias("a").join(dx.alias("b"), (F.col("a.member_id") == F.col("b.member_id"))
                                 & (F.col("a.max_date") == F.col("b.from_date"))
                                 & F.col("b.dx_num").isin(1831, 1832))
          .groupBy(F.col("a.member_id").alias("member_id"), F.col("b.from_date").alias("from_date"))
          .agg(F.max("b.dx_num").alias("dx_num")))
    unspec = (latest.where(F.col("dx_num") == 1830).alias("a")
              .join(s3.alias("b"), "member_id", "left")
              .select("member_id", F.coalesce("b.dx_num", "a.dx_num").alias("dx_num"),
                      F.coalesce("b.from_date", "a.from_date").alias("from_date")))
    others = latest.where(F.col("dx_num") != 1830).select("member_id", "dx_num", "from_date")
    return unspec.unionByName(others).distinct()


def test_latest_dx_equals_self_join(spark):
    dx = _dx_frame(spark)
    _rows_equal(diagnoses.latest_dx(dx).select("member_id", "from_date", "dx_num"),
                _naive_latest(dx).select("member_id", "from_date", "dx_num"))


def test_refinement_equals_naive(spark):
    for seed in (1, 2, 3):
        dx = _dx_frame(spark, seed)
        _rows_equal(diagnoses.dx_stage_final(dx).select("member_id", "dx_num", "from_date"),
                    _naive_final(dx).select("member_id", "dx_num", "from_date"))


def test_refinement_takes_specific_value_and_date(spark):
    rows = [(1, 1, "N1831", _d(1), 1831), (1, 2, "N1832", _d(5), 1832), (1, 3, "N1831", _d(5), 1831),
            (1, 4, "N183", _d(9), 1830),
            (2, 5, "N183", _d(9), 1830),                      # no specific -> stays unspecified
            (3, 6, "N1832", None, 1832), (3, 7, "N183", _d(4), 1830)]  # NULL-date specific ignored
    dx = spark.createDataFrame(rows, "member_id long, claim_id long, dx_code string, from_date date, dx_num int")
    got = {r[0]: (r[1], r[2]) for r in diagnoses.dx_stage_final(dx).collect()}
    assert got == {1: (1832, _d(5)), 2: (1830, _d(9)), 3: (1830, _d(4))}
    assert {r[0] for r in diagnoses.refine_unspecified(dx).collect()} == {1, 2, 3}


def test_parity_rows(spark):
    from stagewise.operators.quality import dx_parity
    dx = _dx_frame(spark)
    r = dx_parity(diagnoses.latest_dx(dx), diagnoses.dx_stage_final(dx)).first()
    assert r["parity"] and r["n_before"] == r["n_after"] > 0


def test_latest_lab_equals_self_join(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(800):
        m = rnd.choice([None] + list(range(1, 50)))
        code = rnd.choice(["33914-3", "33914-3", "other"])
        v = None if rnd.random() < 0.2 else rnd.randrange(5, 120)
        d = None if rnd.random() < 0.05 else _d(rnd.randrange(0, 20))
        rows.append((m, code, None, v, d))
    jvhl = spark.createDataFrame(rows, "member_id long, requestcpt string, numericresult int, "
                                       "all_results int, date_servicebegin date")
    got = labs.latest_lab(jvhl, RunConfig())
    tgt = jvhl.where(F.col("requestcpt") == "33914-3")
    mx = tgt.where(F.col("all_results").isNotNull()).groupBy("member_id").agg(F.max("date_servicebegin").alias("md"))
    naive = (tgt.alias("a").join(mx.alias("b"), (F.col("a.member_id") == F.col("b.member_id"))
                                 & (F.col("a.date_servicebegin") == F.col("b.md")))
             .groupBy(F.col("a.member_id").alias("member_id"), F.col("a.date_servicebegin").alias("date_servicebegin"))
             .agg(F.min("a.all_results").alias("all_results"), F.count_distinct("a.all_results").alias("n_labs")))
    cols = ["member_id", "date_servicebegin", "all_results", "n_labs"]
    _rows_equal(got.select(cols), naive.select(cols))


def test_latest_by_is_one_aggregate_without_window(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    out = latest_by(df, "k", ["t"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert {r["k"]: r["t"] for r in out.collect()} == {k: max(i for i in range(100) if i % 7 == k) for k in range(7)}


def test_persistence_flag_equals_naive(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice([None, 1, 2, 3, 4]), rnd.choice(["33914-3", "other"]),
             rnd.choice([None, 30, 59, 60, 80]), None,
             None if rnd.random() < 0.1 else _d(rnd.randrange(0, 200))) for _ in range(300)]
    jvhl = spark.createDataFrame(rows, "member_id long, requestcpt string, numericresult int, "
                                       "all_results int, date_servicebegin date")
    got = labs.lab_persistence_flags(jvhl, RunConfig())
    low = jvhl.where((F.col("requestcpt") == "33914-3") & (F.col("numericresult") < 60))
    naive = low.groupBy("member_id").agg(
        F.when(F.datediff(F.max("date_servicebegin"), F.min("date_servicebegin")) >= 90, 1)
         .otherwise(0).alias("ckd_jvhl_flag_2labs"))
    _rows_equal(got.select("member_id", "ckd_jvhl_flag_2labs"), naive)
