"""Run parameters and the fixed values the staging rules depend on.

Everything a run can vary lives in :class:`RunConfig`.  The constants below are
not tunables: they are the codes, labels and cut points whose exact spelling
decides which rows match, so they are kept together in one place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES - must stay exactly as written for results to match.
# ---------------------------------------------------------------------------

# Lab test code for the kidney-function (eGFR) result.
TARGET_TEST_CODE = "33914-3"

# Health-plan codes that make up the lab-plan denominator.
DENOMINATOR_PLANS = ("AET", "BCC", "HAP", "MCL", "MER")

# Literal text standing in for a missing numeric lab value.
NULL_SENTINEL = "NULL"

# Threshold text such as ">60" or ">/=90" (matched against the whole string).
THRESHOLD_TEXT_PATTERN = r">/?=? ?(60|90|120).?0?0?"

# Characters stripped from a matched threshold text before it is parsed.
THRESHOLD_STRIP_CHARS = "/=>"

# Diagnosis codes for chronic kidney disease, in source order.
CKD_DX_CODES = ("N181", "N182", "N183", "N1830", "N1831", "N1832", "N184", "N185")

# Parsed diagnosis numbers.
DX_UNSPECIFIED_3 = 1830
DX_SPECIFIC_3 = (1831, 1832)

# Lab value of 60 and below 60 marks reduced kidney function; 90 days apart
# marks a persistent finding.
LAB_FLAG_LIMIT = 60
PERSISTENCE_DAYS = 90

# Lab value bins, first match wins, lower bound inclusive: (lower bound, label).
LAB_BINS_DETAILED = (
    (90, "stage 1"),
    (60, "stage 2"),
    (45, "stage 3a"),
    (30, "stage 3b"),
    (15, "stage 4"),
    (None, "stage 5"),
)
LAB_BINS_COARSE = (
    (60, "stage 1/2"),
    (45, "stage 3a"),
    (30, "stage 3b"),
    (15, "stage 4"),
    (None, "stage 5"),
)
NO_LAB = "0"

# Diagnosis number -> claim stage label.
CLAIM_LABELS = (
    (1810, "stage 1"),
    (1820, "stage 2"),
    (1830, "stage 3, unspecified"),
    (1831, "stage 3a"),
    (1832, "stage 3b"),
    (1840, "stage 4"),
    (1850, "stage 5"),
)
NO_CLAIM_FLAGGED = "0"
NO_CLAIM = ""

# Stage labels used by the combined categories.
STAGE_1 = "stage 1"
STAGE_2 = "stage 2"
STAGE_3A = "stage 3a"
STAGE_3B = "stage 3b"
STAGE_4 = "stage 4"
STAGE_5 = "stage 5"
CLAIM_UNSPECIFIED_3 = "stage 3, unspecified"

SOURCE_LAB = "lab"
SOURCE_CLAIM = "claim"
SOURCE_NONE = ""

# Fine combined category.
COMB_ESRD = "ESRD"
COMB_UNKNOWN = "CKD, stage unknown"
COMB_UNSPECIFIED = "CKD, stage 3 unspecified"
COMB_NONE_OUT = "No lab or claim for CKD, not in JVHL denom"
COMB_NONE_IN = "No lab or claim for CKD, in JVHL denom"
COMB_EMPTY = ""

# Category with unspecified stage 3.
W3_5_ESRD = "stage 5/ESRD"
W3_UNSPECIFIED = "stage 3 unspecified"
W3_NONE = "No lab or claim for CKD"

# Collapsed categories.
COLLAPSED_UNKNOWN = "CKD, stage unknown/unspecified"
COLLAPSED_LOW = "stage 1, stage 2, or no CKD"
# The nominal five-category scheme lists stage 2 spelled without its space, so
# "stage 2" is not folded into the low group.  ``fix_quirks`` uses STAGE_2.
COLLAPSE_B_STAGE2_SPELLING = "stage2"

# Claim service categories (compared case-insensitively).
CAT_INPATIENT = "inpatient"
CAT_CLINIC = "clinic"
CAT_DRUG = "drug"
CAT_OP_FACILITY = "op facility"
CAT_NF = "nf"
CAT_OTHER = "other"
NAMED_CATEGORIES = (CAT_INPATIENT, CAT_CLINIC, CAT_DRUG, CAT_OP_FACILITY, CAT_NF)

# Claim status that is excluded from cost.
EXCLUDED_CLAIM_STATUS = 1

# Adults for the cost and crosstab cohorts.
ADULT_AGE = 18

# Percentiles reported by the distribution helper.
PERCENTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.95, 0.99)

# Stage variables reported per cost scheme, in report order.
COST_STAGE_VARS = (
    "ckd_stage_jvhl_detailed",
    "ckd_stage_claims",
    "ckd_stage_comb_all",
    "ckd_stage_comb_5andesrd",
    "ckd_stage_comb_w3unsp",
    "ckd_stage_comb_5cat",
)

# The cost battery: (category, medical flag, dual flag), in report order.
COST_BATTERY = (
    ("all", "both", "both"),
    ("inpatient", "both", "both"),
    ("clinic", "both", "both"),
    ("op facility", "both", "both"),
    ("nf", "both", "both"),
    ("other", "both", "both"),
    ("all", "Y", "N"),
    ("all", "both", "Y"),
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one staging run.

    year         analysis year; the previous year is read where two years are used
    diagnostics  also build the crosstab, monthly and cost reports
    fix_quirks   repair the known source quirks that are switchable (see README)
    strict_cast  raise on unparseable numeric text instead of yielding NULL
    """

    year: int = 1997
    diagnostics: bool = True
    fix_quirks: bool = False
    strict_cast: bool = False
    target_test: str = TARGET_TEST_CODE
    denominator_plans: tuple[str, ...] = field(default=DENOMINATOR_PLANS)

    def __post_init__(self):
        if not isinstance(self.year, int) or not 1000 <= self.year <= 9999:
            raise ValueError(f"year must be a four-digit int, got {self.year!r}")

    @property
    def prev_year(self) -> int:
        return self.year - 1

    @property
    def aki_current(self) -> str:
        return f"aki_flag_{self.year}"

    @property
    def aki_previous(self) -> str:
        return f"aki_flag_{self.prev_year}"
