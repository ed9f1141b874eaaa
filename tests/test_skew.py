"""Joins and group totals on raw rows: NULL and hot keys, ties, whole payloads, keys of any type."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise import FrameInputs, RunConfig, StagingRun
from stagewise.operators import costs, diagnoses, frequency, latest, quality, skew
from stagewise.sources.catalog import conform

D = dt.date
CFG = RunConfig()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_matches_a_left_join(spark, no_broadcast):
    rng = random.Random(1)
    rows = [(rng.choice([None, None, 1, 2, 3, 9]), i) for i in range(300)]
    table = [(1, "a"), (2, "b"), (2, "c"), (None, "never"), (4, None)]
    df, t = spark.createDataFrame(rows, "k long, i int"), spark.createDataFrame(table, "id long, v string")
    want = Counter()
    for k, i in rows:
        for v in [v for x, v in table if x == k and k is not None] or [None]:
            want[k, i, v] += 1
    out = skew.lookup(df, t, "k", "id", ["v"])
    assert bag(out) == want
    # a row without a key is dealt out by itself: both keys are in the exchange, the other side's is never NULL's
    assert re.search(r"hashpartitioning\(k#\d+L?, _apart#\d+L?, 8\)", plan_of(out))


def test_null_keys_spread_over_tasks(spark, no_broadcast):
    df = spark.range(0, 4000, 1, 4).select(F.lit(None).cast("long").alias("k"), F.lit("same").alias("x"))
    out = skew.lookup(df, spark.createDataFrame([(1, "a")], "id long, v string"), "k", "id", ["v"])
    # equal rows of one partition go together, those of different partitions apart
    spread = df.withColumn("_apart", skew.apart(F.col("k").isNull(), "k", "x")).select("_apart").distinct().count()
    assert spread == 4 and out.count() == 4000 and out.where("v is not null").count() == 0


def test_totals_equal_window_aggregates(spark, monkeypatch, no_broadcast):
    rng = random.Random(2)
    # one key with a third of all rows, NULLs, many small keys
    rows = [(1 if i % 3 == 0 else rng.choice([None, *range(2, 900)]), rng.choice(["x", "y", None]), i) for i in range(9000)]
    df = spark.createDataFrame(rows, "k long, g string, v long")
    by = defaultdict(list)
    for k, g, v in rows:
        by[k].append(v)
    want = Counter((k, g, v, len(by[k]), max(by[k])) for k, g, v in rows)
    out = skew.with_totals(df, ["k"], [F.count(F.lit(1)).alias("n"), F.max("v").alias("top")])
    assert bag(out) == want
    plan = plan_of(out)
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    two = defaultdict(int)
    for k, g, v in rows:
        two[k, g] += 1
    assert bag(skew.with_totals(df, ["k", "g"], [F.count(F.lit(1)).alias("n")])) == Counter((k, g, v, two[k, g]) for k, g, v in rows)
    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    assert bag(skew.with_totals(df, ["k"], [F.count(F.lit(1)).alias("n"), F.max("v").alias("top")])) == want
    assert skew.with_totals(df.limit(0), ["k"], [F.count(F.lit(1)).alias("n")]).count() == 0


def test_rows_on_latest_day_keeps_ties_and_payload(spark):
    rows = [(1, D(1997, 1, 1), 5, "a"), (1, D(1997, 2, 1), None, "b"), (1, D(1997, 2, 1), 7, "c"), (1, D(1997, 2, 1), 7, "c"),
            (2, None, 1, "d"), (None, D(1997, 1, 1), 1, "e"), (3, D(1996, 1, 1), None, "f"), (4, D(1997, 5, 1), None, "g"), (4, D(1997, 4, 1), 2, "h")]
    df = spark.createDataFrame(rows, "m long, d date, v int, extra string")
    assert bag(skew.rows_on_latest_day(df, "m", "d")) == Counter([rows[1], rows[2], rows[3], rows[6], rows[7]])
    # a day counts if it has a value; then all of its rows come
    assert bag(skew.rows_on_latest_day(df, "m", "d", F.col("v").isNotNull())) == Counter([rows[1], rows[2], rows[3], rows[8]])


def test_side_by_side_is_null_safe(spark):
    left = spark.createDataFrame([("a", 1, 10), (None, 1, 20), (None, None, 30), ("b", None, 40)], "k string, j int, n int")
    right = spark.createDataFrame([("a", 1, 1), (None, None, 2), ("b", 2, 3)], "k string, j int, m int")
    assert bag(skew.side_by_side(left, right, ["k", "j"])) == Counter([("a", 1, 10, 1), (None, 1, 20, None), (None, None, 30, 2), ("b", None, 40, None), ("b", 2, None, 3)])
    assert bag(skew.side_by_side(left, right.limit(0), ["k", "j"])) == Counter((k, j, n, None) for k, j, n in bag(left))
    with pytest.raises(ValueError):
        skew.side_by_side(left, left, ["k"])


def test_months_on_rows_of_a_hot_member(spark):
    enroll = [(1, D(1997, 1 + i % 12, 1), "AET", "Y", "N") for i in range(600)] + [(m, D(1997, 1, 1), None, "Y", "N") for m in range(2, 300)] + [(7, D(1997, 2, 1), None, None, "N"), (None, D(1997, 1, 1), None, "Y", "N")]
    member = [(m, 40) for m in range(1, 299)] + [(7, 41), (299, 10), (None, 50)]
    out = costs.months_on_rows(spark.createDataFrame(enroll, "member_id long, begin_date date, mhp string, medical_flag string, dual_flag string"), spark.createDataFrame(member, "member_id long, age int"))
    want = Counter({(1, f"1997{1 + i:02d}", 600): 50 for i in range(12)}) + Counter((m, "199701", 1) for m in range(2, 299) if m != 7) + Counter({(7, "199701", 2): 2})
    assert bag(out) == want


def test_no_task_groups_the_months_of_a_whole_split(spark, monkeypatch):
    # all enrolment in one partition, as one small file gives it: its rows are dealt out before any aggregate of months
    monkeypatch.setattr(skew, "DEALT_ROWS", 800)
    enroll = (spark.range(400).coalesce(1).selectExpr("id AS member_id", "explode(sequence(1, 12)) AS m")
              .selectExpr("member_id", "make_date(1997, m, 1) AS begin_date", "'AET' AS mhp", "'Y' AS medical_flag", "'N' AS dual_flag"))
    per_task = skew.dealt(enroll).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(n > 0 for n in per_task) == 6 and sum(per_task) == 4800 and max(per_task) < 1600
    member = spark.createDataFrame([(i, 40) for i in range(400)], "member_id long, age int")
    claims = spark.createDataFrame([(1, 3, D(1997, 2, 3), Decimal("5.00"), "Clinic")], "claim_id long, member_id long, from_date date, allowed_amt decimal(38,2), fasc_cat_adj string")
    measures = costs.member_measures(enroll, member, claims, {"p": ("both", "both")}, {("p", "all")})
    twice = quality.duplicate_months(enroll.unionByName(enroll.where("member_id = 7")))
    for df in (measures, twice):
        lines = plan_of(df).splitlines()
        deal = next(i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line)
        grouped = next(i for i, line in enumerate(lines) if "HashAggregate(keys=[member_id" in line and "month" in line and "partial_" in line)
        assert grouped < deal  # the aggregate of months is above the exchange that deals its rows
    assert {r["member_id"]: (r["p__months"], r["p__c_all"]) for r in measures.collect()} == {i: (12, Decimal("5.00") if i == 3 else None) for i in range(400)}
    assert bag(twice) == Counter({(7, f"1997{m:02d}", 2): 1 for m in range(1, 13)})


def test_distinct_members_in_a_battery(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice(["x", "y"]), rng.choice([None, 10, 30]), rng.choice([None, *[f"M{i}" for i in range(400)]])) for _ in range(4000)]
    rows += [("a", "x", 30, "hot")] * 2000
    df = spark.createDataFrame(rows, "g string, h string, age int, m string")
    tables = [frequency.Table(1, "g", ("g",)), frequency.Table(2, "g, adults", ("g",), "age >= 18"), frequency.Table(3, "both", ("g", "h")), frequency.Table(4, "none", ("h",), "age > 99")]
    got = Counter(tuple(r) for r in frequency.stacked_distinct(df, tables, "m").collect())
    want = Counter()
    for t in tables:
        cells = defaultdict(list)
        for g, h, age, m in rows:
            if t.where is None or (age is not None and age >= 18 and t.table_id == 2):
                cells[tuple({"g": g, "h": h}[d] for d in t.dims)].append(m)
        for vals, ms in cells.items():
            names = [x for d, v in zip(t.dims, vals) for x in (d, v)] + [None] * (4 - 2 * len(t.dims))
            want[(t.table_id, t.title, *names, len(ms), len({m for m in ms if m is not None}))] += 1
    assert got == want


def test_bitmaps_over_many_buckets(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 120_000).alias("m"))
    got = {r["val1"]: r["n_members"] for r in frequency.stacked_distinct(df, [frequency.Table(1, "g", ("g",))], "m").collect()}
    assert got == {r["g"]: r["n"] for r in df.selectExpr("cast(g as string) as g", "m").groupBy("g").agg(F.count_distinct("m").alias("n")).collect()}


# ---- keys and rows as they are

def frames(spark, key):
    rng = random.Random(6)
    ids = list(range(1, 40))
    day = lambda: D(rng.choice([1996, 1997]), rng.randint(1, 12), rng.randint(1, 28))
    k = lambda i: None if i is None else key(i)
    kind = "string" if isinstance(key(1), str) else "long"
    claims = list(range(100, 220))
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl.replace("KEY", kind))
    labs = [(k(rng.choice([None, *ids])), "33914-3", rng.choice(["NULL", "59.4", "20", "95", None]), rng.choice([None, ">60"]), day()) for _ in range(300)]
    dx = [(k(rng.choice([None, *ids])), k(rng.choice([None, *claims])), rng.choice(["N181", "N183", "N1831", "N184", "I10"]), rng.choice("pq")) for _ in range(200)]
    enroll = [(k(i), D(1997, m, 1), rng.choice(["AET", "OTH"]), "Y", "N") for i in ids for m in range(1, 1 + rng.randint(1, 12))]
    flags = [(k(i), rng.choice([0, 1, None]), rng.choice([0, 0, 1]), rng.choice([0, 1])) for i in ids]
    bills = [(k(c), k(rng.choice(ids)), day().replace(year=1997), rng.randint(1, 500), rng.choice([0, 1, 2])) for c in claims for _ in range(rng.randint(1, 3))]
    return FrameInputs({
        "labs": make(labs, "member_id KEY, requestcpt string, numericresult string, textresult string, date_servicebegin date"),
        "enroll": {1997: make(enroll, "member_id KEY, begin_date date, mhp string, medical_flag string, dual_flag string")},
        "condition_flags": {y: make(flags, "member_id KEY, ckd int, esrd int, aki int") for y in (1996, 1997)},
        "member": {1997: make([(k(i), rng.choice([10, 20, 60, None])) for i in ids], "member_id KEY, age int")},
        "dx_long": {1997: make(dx[:120], "member_id KEY, claim_id KEY, dx_code string, place string"), 1996: make(dx[100:], "member_id KEY, claim_id KEY, dx_code string, place string")},
        "claim_headers": make([(k(c), rng.choice([None, day()])) for c in claims], "claim_id KEY, from_date date"),
        "claims": {1997: make(bills, "claim_id KEY, member_id KEY, from_date date, allowed_amt int, claim_status int")},
        "claim_category": {1997: make([(k(c), rng.choice(["Inpatient", "Clinic", None])) for c in claims], "claim_id KEY, fasc_cat string")},
        "inpatient_header": {1997: make([(k(c), rng.randint(1, 900)) for c in claims[::3]], "claim_id KEY, allowed_amount int")},
    })


def test_text_keys_give_the_same_run(spark):
    number, text = StagingRun(frames(spark, lambda i: i), CFG), StagingRun(frames(spark, lambda i: f"A{i}"), CFG)
    named = lambda df: Counter((f"A{r['member_id']}", *r[1:]) for r in df.collect())
    assert named(number.final_flags) == bag(text.final_flags)
    assert named(number.dx_final) == bag(text.dx_final)
    assert named(number.member_cost()) == bag(text.member_cost())
    assert bag(number.cost_battery) == bag(text.cost_battery)
    assert dict(text.final_flags.dtypes)["member_id"] == "string"


def test_keys_of_mixed_types_are_cast_by_the_resolver(spark):
    df = spark.createDataFrame([(7, 40)], "member_id int, age int")
    assert dict(conform(df, "member").dtypes) == {"member_id": "int", "age": "int"}
    assert conform(df, "member", {"member_id": "string"}).collect()[0]["member_id"] == "7"


def test_whole_rows_of_diagnoses(spark):
    cur = spark.createDataFrame([(1, 5, "N181", "p"), (1, 5, "N181", "p"), (1, 5, "N181", "q"), (1, None, "N182", "p"), (2, 6, "I10", "p")], "member_id long, claim_id long, dx_code string, place string")
    prev = spark.createDataFrame([(1, 5, "N181", "p"), (1, None, "N182", "p")], "member_id long, claim_id long, dx_code string, place string")
    heads = spark.createDataFrame([(5, D(1997, 3, 1)), (None, D(1997, 4, 1))], "claim_id long, from_date date")
    out = diagnoses.parse_dx(conform(cur, "dx_long"), conform(prev, "dx_long"), heads)
    assert out.columns == ["member_id", "claim_id", "dx_code", "place", "from_date", "dx_num"]
    assert bag(out) == Counter([(1, 5, "N181", "p", D(1997, 3, 1), 1810), (1, 5, "N181", "q", D(1997, 3, 1), 1810), (1, None, "N182", "p", None, 1820)])
    only = prev.drop("place")
    assert Counter(r["place"] for r in diagnoses.parse_dx(cur, only, heads).collect()) == Counter(["p", "q", "p", None, None])
    with pytest.raises(ValueError):
        diagnoses.parse_dx(cur.withColumn("from_date", F.lit(None)), prev, heads)


def test_diagnoses_are_read_once_and_made_distinct_once(spark, no_broadcast):
    from stagewise import DriverFixtures
    plan = plan_of(StagingRun(DriverFixtures(spark, "/root/testdata/sf0.001"), CFG).dx_parsed(distinct=True))
    assert plan.count("FileScan") == 3                      # two years, one header table
    assert len(re.findall(r"Exchange hashpartitioning\(member_id", plan)) == 1


def test_a_code_outside_its_range_fails(spark):
    df = spark.createDataFrame([(D(1997, 1, 1), 250_000)], "d date, c long")
    with pytest.raises(Exception, match="code out of range"):
        df.select(latest.date_code_key(F.col("d"), F.col("c"))).collect()
    ok = spark.createDataFrame([(D(1997, 1, 1), 99_998), (D(1997, 1, 1), None)], "d date, c long")
    key = latest.date_code_key(F.col("d"), F.col("c"))
    assert bag(ok.select(latest.key_date(key), latest.key_code(key))) == Counter([(D(1997, 1, 1), 99_998), (D(1997, 1, 1), None)])
