"""Claim preparation over bucketed tables moves nothing; over others it moves sums."""

import datetime as dt
import re
import tempfile
from collections import Counter
from decimal import Decimal

from stagewise import DriverFixtures, FrameInputs, RunConfig
from stagewise.operators import costs
from stagewise.sources import write_bucketed

CFG = RunConfig()
SF = "/root/testdata/sf0.001"


def prepared(inputs):
    return costs.claim_cost(*[inputs.table(n, CFG.year) for n in ("claims", "claim_category", "inpatient_header")], CFG)


def exchanges(df):
    return re.findall(r"Exchange (\w+\([^)]*\))", df._jdf.queryExecution().executedPlan().toString())


def test_no_exchange_on_bucketed_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = DriverFixtures(spark, SF)
        bucketed = write_bucketed(plain, CFG.year, tempfile.mkdtemp(prefix="stagewise-buckets-"), 4, prefix="bk_")
        df = prepared(bucketed)
        assert exchanges(df) == []
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, prepared(plain).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_claim_is_summed_before_it_moves(spark):
    lines = [(1, 5, dt.date(1997, 1, 1 + i % 28), Decimal("1.25"), 0) for i in range(2000)] + [(c, c % 7, dt.date(1997, 2, 1), Decimal(c), c % 3) for c in range(2, 600)]
    frames = FrameInputs({"claims": {1997: spark.createDataFrame(lines, "claim_id long, member_id long, from_date date, allowed_amt decimal(18,2), claim_status int")},
                          "claim_category": {1997: spark.createDataFrame([(c, "Clinic") for c in range(1, 600)], "claim_id long, fasc_cat string")},
                          "inpatient_header": {1997: spark.createDataFrame([(3, Decimal(9))], "claim_id long, allowed_amount decimal(18,2)")}})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = prepared(frames)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\(claim_id#\d+L, member_id#\d+L[^\n]*\n[^\n]*HashAggregate\(keys=\[claim_id[^\n]*partial_sum", plan)
        assert {r["claim_id"]: r["allowed_amt"] for r in df.collect()}[1] == Decimal("2500.00")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
