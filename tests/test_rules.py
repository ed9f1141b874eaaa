"""Rule tables: bins at every boundary, claim labels, arbitration, categories."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise.config import RunConfig
from stagewise.functions import rules as R


@pytest.mark.parametrize("v,coarse,detailed", [
    (14, "stage 5", "stage 5"), (15, "stage 4", "stage 4"), (29, "stage 4", "stage 4"),
    (30, "stage 3b", "stage 3b"), (44, "stage 3b", "stage 3b"), (45, "stage 3a", "stage 3a"),
    (59, "stage 3a", "stage 3a"), (60, "stage 1/2", "stage 2"), (89, "stage 1/2", "stage 2"),
    (90, "stage 1/2", "stage 1"), (None, "0", "0"),
])
def test_lab_bins(spark, v, coarse, detailed):
    df = spark.createDataFrame([(Decimal(v) if v is not None else None,)], "v decimal(38,0)")
    r = df.select(R.lab_stage_coarse(F.col("v")), R.lab_stage_detailed(F.col("v"))).first()
    assert (r[0], r[1]) == (coarse, detailed)


@pytest.mark.parametrize("num,flag,label", [
    (1810, 1, "stage 1"), (1820, 0, "stage 2"), (1830, None, "stage 3, unspecified"),
    (1831, 1, "stage 3a"), (1832, 1, "stage 3b"), (1840, 1, "stage 4"), (1850, 1, "stage 5"),
    (None, 1, "0"), (None, 0, ""), (None, None, ""), (1999, 1, ""),
])
def test_claim_labels(spark, num, flag, label):
    df = spark.createDataFrame([(Decimal(num) if num is not None else None, flag)], "n decimal(38,0), f int")
    assert df.select(R.claim_stage_label(F.col("n"), F.col("f"))).first()[0] == label


LAB_LATER, CLAIM_LATER, TIE = "lab later", "claim later", "tie"
D0, D1 = dt.date(1997, 1, 1), dt.date(1997, 6, 1)


@pytest.mark.parametrize("timing,claim,lab,expected", [
    (LAB_LATER, "stage 3a", "stage 2", "lab"),
    (CLAIM_LATER, "stage 3a", "stage 2", "claim"),
    (TIE, "stage 3a", "stage 2", "claim"),
    (CLAIM_LATER, "stage 3, unspecified", "stage 2", "lab"),   # any lab beats unspecified 3
    (TIE, "stage 3, unspecified", "stage 2", "lab"),
    (CLAIM_LATER, "", "stage 4", "lab"),
    (CLAIM_LATER, "0", "stage 4", "lab"),
    (None, "stage 4", "0", "claim"),       # no lab at all
    (None, "", "0", ""),
    (None, "0", "0", ""),
    (None, "", "stage 1", "lab"),
])
def test_arbitration(spark, timing, claim, lab, expected):
    lab_date = {LAB_LATER: D1, CLAIM_LATER: D0, TIE: D1, None: None}[timing]
    claim_date = {LAB_LATER: D0, CLAIM_LATER: D1, TIE: D1, None: None}[timing]
    if lab == "0":
        lab_date = None
    if claim in ("", "0"):
        claim_date = None
    df = spark.createDataFrame([(lab_date, claim_date, claim, lab)], "ld date, cd date, c string, l string")
    src = R.recent_source(F.col("ld"), F.col("cd"), F.col("c"), F.col("l"))
    r = df.select(src.alias("s"), R.chosen_stage(src, F.col("l"), F.col("c")).alias("st")).first()
    assert r["s"] == expected
    assert r["st"] == {"lab": lab, "claim": claim, "": ""}[expected]


def _cats(spark, esrd, f, claim, lab, stage, denom, source, fix=False):
    df = spark.createDataFrame([(esrd, f, claim, lab, stage, denom, source)],
                               "e int, f int, c string, l string, s string, d int, src string")
    c = F.col
    all_ = R.stage_comb_all(c("e"), c("f"), c("c"), c("l"), c("s"), c("d"))
    w3 = R.stage_comb_w3unsp(c("e"), c("f"), c("c"), c("l"), c("s"), c("src"))
    r = df.select(all_.alias("a"), w3.alias("w")).select(
        "a", "w", R.collapse_5andesrd(F.col("a")).alias("a5"), R.collapse_5cat(F.col("w"), fix).alias("w5")).first()
    return r["a"], r["w"], r["a5"], r["w5"]


def test_esrd_wins(spark):
    assert _cats(spark, 1, 1, "stage 2", "stage 2", "stage 2", 1, "claim") == (
        "ESRD", "stage 5/ESRD", "stage 5/ESRD", "stage 5/ESRD")


def test_stage2_needs_no_flag_in_fine_but_claim_in_w3(spark):
    a, w, a5, w5 = _cats(spark, 0, 0, "", "stage 2", "stage 2", 1, "lab")
    assert (a, w, a5) == ("stage 2", "No lab or claim for CKD", "stage 2")
    assert w5 == "stage 1, stage 2, or no CKD"


def test_stage2_spelling_quirk(spark):
    # claim-chosen stage 2 stays its own category in the 5-category scheme unless fixed
    assert _cats(spark, 0, 1, "stage 2", "0", "stage 2", 1, "claim")[3] == "stage 2"
    assert _cats(spark, 0, 1, "stage 2", "0", "stage 2", 1, "claim", fix=True)[3] == "stage 1, stage 2, or no CKD"


def test_unflagged_specific_stage_is_none(spark):
    # coded 3a-5 without either flag -> reported as no lab or claim (Q6)
    assert _cats(spark, 0, 0, "stage 4", "0", "stage 4", 0, "claim")[0] == \
        "No lab or claim for CKD, not in JVHL denom"


def test_unspecified_with_low_lab(spark):
    # flagged, claim unspecified 3, lab stage 1: fine -> stage 1; w3 -> none (Q7)
    a, w, _, _ = _cats(spark, 0, 1, "stage 3, unspecified", "stage 1", "stage 1", 1, "lab")
    assert (a, w) == ("stage 1", "No lab or claim for CKD")


def test_unknown_and_unspecified(spark):
    assert _cats(spark, 0, 1, "0", "0", "", 1, "")[:3] == (
        "CKD, stage unknown", "CKD, stage unknown", "CKD, stage unknown/unspecified")
    a, w, a5, w5 = _cats(spark, 0, 1, "stage 3, unspecified", "0", "stage 3, unspecified", 0, "claim")
    assert (a, w, a5, w5) == ("CKD, stage 3 unspecified", "stage 3 unspecified",
                              "CKD, stage unknown/unspecified", "CKD, stage unknown/unspecified")


def test_null_flags_fall_to_else(spark):
    # NULL esrd / flag comparisons are not matches
    a, w, _, _ = _cats(spark, None, 1, "stage 4", "0", "stage 4", 0, "claim")
    assert (a, w) == ("stage 4", "stage 4")
    a, _, _, _ = _cats(spark, None, None, "", "0", "", None, "")
    assert a == ""


def test_config_validates_year():
    with pytest.raises(ValueError):
        RunConfig(year=97)
    assert RunConfig(year=2020).prev_year == 2019


# Every (claim label, lab label) of a member without end-stage disease, by hand:
# rows are claim labels, columns the lab labels none, 1, 2, 3a, 3b, 4, 5.
# "-" is no category, "?" stage unknown, "u" unspecified 3, "E" stage 5/ESRD.
LABS = ("0", "stage 1", "stage 2", "stage 3a", "stage 3b", "stage 4", "stage 5")
CLAIMS = ("", "0", "stage 3, unspecified", "stage 1", "stage 2", "stage 3a", "stage 3b", "stage 4", "stage 5")
GRIDS = {  # (category, flagged, which source is later)
    ("fine", 1, "claim"): """? 1 2 3a 3b 4 5
                             ? 1 2 3a 3b 4 5
                             u 1 2 3a 3b 4 5
                             1 1 1 1 1 1 1
                             2 2 2 2 2 2 2
                             3a 3a 3a 3a 3a 3a 3a
                             3b 3b 3b 3b 3b 3b 3b
                             4 4 4 4 4 4 4
                             5 5 5 5 5 5 5""",
    ("fine", 1, "lab"): """? 1 2 3a 3b 4 5
                           ? 1 2 3a 3b 4 5
                           u 1 2 3a 3b 4 5
                           1 1 2 3a 3b 4 5
                           2 1 2 3a 3b 4 5
                           3a 1 2 3a 3b 4 5
                           3b 1 2 3a 3b 4 5
                           4 1 2 3a 3b 4 5
                           5 1 2 3a 3b 4 5""",
    ("fine", 0, "claim"): """- 1 2 - - - -
                             - 1 2 - - - -
                             - 1 2 - - - -
                             1 1 1 1 1 1 1
                             2 2 2 2 2 2 2
                             - - - - - - -
                             - - - - - - -
                             - - - - - - -
                             - - - - - - -""",
    ("fine", 0, "lab"): """- 1 2 - - - -
                           - 1 2 - - - -
                           - 1 2 - - - -
                           1 1 2 - - - -
                           2 1 2 - - - -
                           - 1 2 - - - -
                           - 1 2 - - - -
                           - 1 2 - - - -
                           - 1 2 - - - -""",
    ("w3", 1, "claim"): """? ? ? 3a 3b 4 E
                           ? ? ? 3a 3b 4 E
                           u - - 3a 3b 4 E
                           1 1 1 1 1 1 1
                           2 2 2 2 2 2 2
                           3a 3a 3a 3a 3a 3a 3a
                           3b 3b 3b 3b 3b 3b 3b
                           4 4 4 4 4 4 4
                           E E E E E E E""",
    ("w3", 1, "lab"): """? ? ? 3a 3b 4 E
                         ? ? ? 3a 3b 4 E
                         u - - 3a 3b 4 E
                         1 - - 3a 3b 4 E
                         2 - - 3a 3b 4 E
                         3a - - 3a 3b 4 E
                         3b - - 3a 3b 4 E
                         4 - - 3a 3b 4 E
                         E - - 3a 3b 4 E""",
    ("w3", 0, "claim"): """- - - - - - -
                           - - - - - - -
                           - - - - - - -
                           1 1 1 1 1 1 1
                           2 2 2 2 2 2 2
                           - - - - - - -
                           - - - - - - -
                           - - - - - - -
                           - - - - - - -""",
    ("w3", 0, "lab"): """- - - - - - -
                         - - - - - - -
                         - - - - - - -
                         1 - - - - - -
                         2 - - - - - -
                         - - - - - - -
                         - - - - - - -
                         - - - - - - -
                         - - - - - - -""",
}
NAMED = {"fine": {"?": "CKD, stage unknown", "u": "CKD, stage 3 unspecified"},
         "w3": {"?": "CKD, stage unknown", "u": "stage 3 unspecified", "E": "stage 5/ESRD", "-": "No lab or claim for CKD"}}


def test_categories_of_every_label_pair(spark):
    rows, expected = [], {}
    for (kind, flag, later), grid in GRIDS.items():
        for claim, line in zip(CLAIMS, grid.splitlines(), strict=True):
            for lab, cell in zip(LABS, line.split(), strict=True):
                for denom in (0, 1):
                    key = (flag, later, claim, lab, denom)
                    none = f"No lab or claim for CKD, {'' if denom else 'not '}in JVHL denom"
                    names = NAMED[kind] | ({"-": none} if kind == "fine" else {})
                    expected.setdefault(key, {})[kind] = names.get(cell, f"stage {cell}")
    for flag, later, claim, lab, denom in expected:
        for esrd in (0, 1, None):
            lab_date = None if lab == "0" else D1 if later == "lab" else D0
            claim_date = None if claim in ("", "0") else D0 if later == "lab" else D1
            rows.append((esrd, flag, later, claim, lab, denom, lab_date, claim_date))
    df = spark.createDataFrame(rows, "e int, f int, later string, c string, l string, d int, ld date, cd date")
    c = F.col
    df = df.withColumn("src", R.recent_source(c("ld"), c("cd"), c("c"), c("l")))
    df = df.withColumn("s", R.chosen_stage(c("src"), c("l"), c("c")))
    got = df.select("*", R.stage_comb_all(c("e"), c("f"), c("c"), c("l"), c("s"), c("d")).alias("fine"),
                    R.stage_comb_w3unsp(c("e"), c("f"), c("c"), c("l"), c("s"), c("src")).alias("w3")).collect()
    assert len(got) == 3 * 2 * 2 * len(CLAIMS) * len(LABS) * 2
    for r in got:
        want = {"fine": "ESRD", "w3": "stage 5/ESRD"} if r["e"] == 1 else expected[r["f"], r["later"], r["c"], r["l"], r["d"]]
        assert (r["fine"], r["w3"]) == (want["fine"], want["w3"]), r
