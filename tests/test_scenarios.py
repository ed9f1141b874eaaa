"""Crafted members walking through the whole staging graph, one quirk each."""

import datetime as dt

import pytest

from stagewise import FrameInputs, RunConfig, StagingRun
from stagewise.sources.schemas import LOGICAL

Y, P = 1997, 1996
D = dt.date


def _df(spark, name, rows):
    return spark.createDataFrame(rows, LOGICAL[name][0])


@pytest.fixture(scope="module")
def flags(spark):
    T = "33914-3"
    labs = [
        (1, T, "45", ">60", D(1997, 3, 1)),        # numeric 45 flags; threshold 60 stages
        (2, T, "NULL", ">60", D(1997, 3, 1)),      # threshold only: staged, not flagged
        (3, T, "20", None, D(1996, 12, 1)),        # lab between the specific and unspecified dx
    ]
    dx_cur = [(3, 301, "N183")]                    # unspecified stage 3, latest
    dx_prev = [(3, 302, "N1831")]                  # older specific stage 3a
    headers = [(301, D(1997, 6, 1)), (302, D(1996, 5, 1))]
    enroll = [(m, D(Y, 1, 1), "AET", "Y", "N") for m in (1, 2, 3, 4)]
    member = [(m, 40) for m in (1, 2, 3, 4)]
    cond = [(1, 0, 0, 0), (2, 1, 0, 0), (3, 1, 0, 1)]  # member 4 has no row
    frames = {
        "labs": _df(spark, "labs", labs),
        "claim_headers": _df(spark, "claim_headers", headers),
        "enroll": {Y: _df(spark, "enroll", enroll)},
        "member": {Y: _df(spark, "member", member)},
        "condition_flags": {Y: _df(spark, "condition_flags", cond), P: _df(spark, "condition_flags", [])},
        "dx_long": {Y: _df(spark, "dx_long", dx_cur), P: _df(spark, "dx_long", dx_prev)},
        "claims": {Y: _df(spark, "claims", [])},
        "claim_category": {Y: _df(spark, "claim_category", [])},
        "inpatient_header": {Y: _df(spark, "inpatient_header", [])},
    }
    run = StagingRun(FrameInputs(frames), RunConfig(year=Y))
    return {r["member_id"]: r.asDict() for r in run.final_flags.collect()}


def test_lab_flag_uses_numeric_value_stage_uses_threshold(flags):
    m1, m2 = flags[1], flags[2]
    assert (m1["ckd_jvhl_flag"], m1["ckd_stage_jvhl_detailed"], m1["ckd_stage"]) == (1, "stage 2", "stage 2")
    assert (m2["ckd_jvhl_flag"], m2["ckd_stage_jvhl_detailed"]) == (0, "stage 2")
    # flagged by condition, no claim stage, lab stage 2: fine "stage 2", w3 "stage unknown"
    assert (m2["ckd_stage_claims"], m2["recent_stage"]) == ("0", "lab")
    assert (m2["ckd_stage_comb_all"], m2["ckd_stage_comb_w3unsp"]) == ("stage 2", "CKD, stage unknown")


def test_refined_stage_takes_the_older_date_and_loses_to_a_later_lab(flags):
    m3 = flags[3]
    assert m3["ckd_stage_claims"] == "stage 3a"
    assert m3["ckd_stage_claims_date"] == D(1996, 5, 1)        # not the 1997-06-01 unspecified date
    assert (m3["recent_stage"], m3["ckd_stage"]) == ("lab", "stage 4")
    assert m3["ckd_stage_comb_all"] == "stage 4"


def test_missing_condition_rows_stay_null_previous_year_is_zero(flags):
    m4 = flags[4]
    assert m4["ckd_ccw_flag"] is None and m4["esrd_flag"] is None and m4["aki_flag_1997"] is None
    assert m4["aki_flag_1996"] == 0
    assert (m4["ckd_ccw_lab_flag"], m4["ckd_stage_claims"]) == (0, "")
    assert m4["ckd_stage_comb_all"] == "No lab or claim for CKD, in JVHL denom"
