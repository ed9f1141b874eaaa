"""Member stage: bins, claim labels, source arbitration and combined categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions import rules as R
from .members import member_columns

STAGE_COLUMNS = ("ckd_stage_jvhl", "ckd_stage_jvhl_detailed", "ckd_stage_claims",
                 "ckd_stage_claims_date", "ckd_stage_jvhl_date", "recent_stage",
                 "ckd_stage", "ckd_ccw_lab_flag")

CATEGORY_COLUMNS = ("ckd_stage_comb_all", "ckd_stage_comb_w3unsp",
                    "ckd_stage_comb_5andesrd", "ckd_stage_comb_5cat")


def member_stage(member_wide: DataFrame, dx: DataFrame, cfg: RunConfig) -> DataFrame:
    """Attach the latest claim stage to every member and choose one stage.

    ``member_wide``: :func:`~stagewise.operators.members.member_rollup_wide`
    (member flags plus ``_lab_date`` / ``_lab_value`` of the latest lab day);
    ``dx``: member_id, dx_num, from_date (dx_stage_final).  One row per member
    on both sides, so the left join keeps the member grain and both inputs are
    keyed (and shuffled) by member_id only.
    """
    d = dx.select(F.col("member_id").alias("_did"), F.col("dx_num").alias("_dx"),
                  F.col("from_date").alias("_ddate"))
    j = member_wide.join(d, F.col("member_id") == F.col("_did"), "left")
    v, lab_date, claim_date = F.col("_lab_value"), F.col("_lab_date"), F.col("_ddate")
    coarse = R.lab_stage_coarse(v)
    detailed = R.lab_stage_detailed(v)
    claims = R.claim_stage_label(F.col("_dx"), F.col("ckd_ccw_flag"))
    source = R.recent_source(lab_date, claim_date, claims, detailed)
    stage = R.chosen_stage(source, detailed, claims)
    either = R.either_source_flag(F.col("ckd_ccw_flag"), F.col("ckd_jvhl_flag"))
    return j.select(*member_columns(cfg),
                    coarse.alias("ckd_stage_jvhl"),
                    detailed.alias("ckd_stage_jvhl_detailed"),
                    claims.alias("ckd_stage_claims"),
                    claim_date.alias("ckd_stage_claims_date"),
                    lab_date.alias("ckd_stage_jvhl_date"),
                    source.alias("recent_stage"),
                    stage.alias("ckd_stage"),
                    either.alias("ckd_ccw_lab_flag"))


def final_flags(stage: DataFrame, cfg: RunConfig) -> DataFrame:
    """Add the combined categories and the two collapsed reporting schemes."""
    c = F.col
    comb_all = R.stage_comb_all(c("esrd_flag"), c("ckd_ccw_lab_flag"), c("ckd_stage_claims"),
                                c("ckd_stage_jvhl_detailed"), c("ckd_stage"), c("jvhl_denom_flag"))
    w3 = R.stage_comb_w3unsp(c("esrd_flag"), c("ckd_ccw_lab_flag"), c("ckd_stage_claims"),
                             c("ckd_stage_jvhl_detailed"), c("ckd_stage"), c("recent_stage"))
    return (stage.select("*", comb_all.alias("ckd_stage_comb_all"),
                         w3.alias("ckd_stage_comb_w3unsp"))
                 .select("*",
                         R.collapse_5andesrd(c("ckd_stage_comb_all")).alias("ckd_stage_comb_5andesrd"),
                         R.collapse_5cat(c("ckd_stage_comb_w3unsp"), cfg.fix_quirks)
                          .alias("ckd_stage_comb_5cat")))
