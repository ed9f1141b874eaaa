"""Claim cost and exposure quirks (Q9-Q15) and battery = one-variant equality."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise.config import COST_BATTERY, RunConfig
from stagewise.operators import costs

CFG = RunConfig()


def _claims(spark, rows):
    return spark.createDataFrame(rows, "claim_id long, member_id long, from_date date, "
                                       "allowed_amt decimal(18,2), claim_status int")


def test_claim_cost_multiplicity_and_status(spark):
    d = dt.date(1997, 2, 3)
    claims = _claims(spark, [
        (1, 10, d, Decimal("10.00"), 0), (1, 10, dt.date(1997, 2, 9), Decimal("5.00"), 2),
        (1, 10, d, Decimal("99.00"), 1),          # status 1 dropped
        (1, 10, d, Decimal("99.00"), None),       # NULL status dropped (!= 1 is NULL)
        (2, 11, d, Decimal("7.00"), 0),           # inpatient with no header amount -> NULL
        (3, 12, d, Decimal("4.00"), 0),           # two category rows -> doubled
        (4, 13, d, Decimal("3.00"), 0),           # NULL category -> other
    ])
    cat = spark.createDataFrame([(1, "Clinic"), (2, "InPatient"), (3, "NF"), (3, "NF"), (4, None)],
                                "claim_id long, fasc_cat string")
    ip = spark.createDataFrame([(1, Decimal("1.00")), (1, Decimal("2.00")), (3, Decimal("8.00"))],
                               "claim_id long, allowed_amount decimal(18,2)")
    got = {r["claim_id"]: (r["from_date"], r["allowed_amt"], r["fasc_cat_adj"])
           for r in costs.claim_cost(claims, cat, ip, CFG).collect()}
    # claim 1: lines 15.00 x 1 category row x 2 header rows = 30.00
    assert got[1] == (dt.date(1997, 2, 9), Decimal("30.00"), "Clinic")
    assert got[2] == (d, None, "InPatient")
    assert got[3] == (d, Decimal("8.00"), "NF")     # 4.00 x 2 categories x 1 header
    assert got[4] == (d, Decimal("3.00"), "other")


def _exposure_inputs(spark):
    enroll = spark.createDataFrame([
        (1, dt.date(1997, 1, 1), "AET", "Y", "N"), (1, dt.date(1997, 2, 1), "AET", "Y", "N"),
        (1, dt.date(1997, 2, 1), "AET", "Y", "N"),        # duplicate month: doubles months and cost
        (2, dt.date(1997, 1, 1), "OTH", "N", "Y"),        # no claims: NULL cost, still years
        (3, dt.date(1997, 1, 1), "OTH", "Y", "N"),        # 17 years old
        (4, dt.date(1997, 1, 1), "OTH", "Y", "N"),        # NULL age
        (5, dt.date(1997, 1, 1), "OTH", None, "N"),       # NULL flag dropped even for 'both'
    ], "member_id long, begin_date date, mhp string, medical_flag string, dual_flag string")
    member = spark.createDataFrame([(1, 40), (2, 70), (3, 17), (4, None), (5, 50)], "member_id long, age int")
    prep = spark.createDataFrame([
        (100, 1, dt.date(1997, 2, 10), Decimal("10.00"), "Clinic"),
        (101, 1, dt.date(1997, 3, 10), Decimal("50.00"), "Clinic"),   # month not enrolled
        (102, 1, dt.date(1997, 1, 5), Decimal("7.00"), "Drug"),
        (103, 3, dt.date(1997, 1, 5), Decimal("9.00"), "Clinic"),
    ], "claim_id long, member_id long, from_date date, allowed_amt decimal(38,2), fasc_cat_adj string")
    flags = spark.createDataFrame(
        [(m, "stage 2", "stage 3a", "stage 2", "stage 2", "stage 2", "stage 2", 1) for m in (1, 2, 3, 4, 5)],
        "member_id long, ckd_stage_jvhl_detailed string, ckd_stage_claims string, ckd_stage_comb_all string, "
        "ckd_stage_comb_5andesrd string, ckd_stage_comb_w3unsp string, ckd_stage_comb_5cat string, "
        "ckd_no_esrd_flag int")
    return enroll, member, prep, flags


def test_member_cost_exposure_rules(spark):
    enroll, member, prep, flags = _exposure_inputs(spark)
    got = {r["member_id"]: (r["cost_sum"], r["n_year"]) for r in
           costs.member_cost(enroll, member, prep, flags).collect()}
    assert set(got) == {1, 2}
    assert got[1] == (Decimal("20.00"), Decimal("0.250000"))   # 10.00 twice (dup month); 3 months
    assert got[2] == (None, Decimal("0.083333"))
    got = {r["member_id"]: r["cost_sum"] for r in
           costs.member_cost(enroll, member, prep, flags, category="drug").collect()}
    assert got == {1: Decimal("7.00"), 2: None}


def test_years_fixed_point(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 13)], "n long")
    got = [r[0] for r in df.select(costs._years(F.col("n"))).collect()]
    assert got[4] == Decimal("0.416667") and got[0] == Decimal("0.083333") and got[11] == Decimal("1.000000")


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_battery_matches_single_variants(spark, sf):
    from stagewise import DriverFixtures, StagingRun
    run = StagingRun(DriverFixtures(spark, sf), CFG)
    battery = run.cost_battery.collect()
    for tid, (cat, med, dual) in enumerate(COST_BATTERY, 1):
        single = {(r["stage_var"], r["stage"]): (r["total_cost"], r["n_year"])
                  for r in run.cost_by_stage(cat, med, dual).collect()}
        mine = {(r["stage_var"], r["stage"]): (r["total_cost"], r["n_year"])
                for r in battery if r["table_id"] == tid}
        assert mine == single, (cat, med, dual)
