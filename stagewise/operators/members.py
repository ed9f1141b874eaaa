"""Member roll-up: one row per enrolled member with the flags staging needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PERSISTENCE_DAYS, RunConfig


MEMBER_FLAG_COLUMNS = ("jvhl_denom_flag", "ckd_jvhl_flag", "ckd_jvhl_flag_2labs",
                       "ckd_no_esrd_jvhl_flag", "ckd_no_esrd_flag", "ckd_ccw_flag", "esrd_flag")


def member_columns(cfg: RunConfig) -> list[str]:
    return ["member_id", *MEMBER_FLAG_COLUMNS, cfg.aki_current, cfg.aki_previous, "age"]


def member_rollup_wide(enroll: DataFrame, lab_summary: DataFrame, cond_current: DataFrame,
                       cond_previous: DataFrame, member: DataFrame, cfg: RunConfig) -> DataFrame:
    """Collapse monthly enrolment to the member and attach lab and condition flags.

    Every member-level value is a maximum, so each side is reduced to one row
    per member *before* the joins (enrolment months never enter a join) and the
    joins are all on ``member_id``, co-partitioned by the aggregates' shuffles.

    ``lab_summary`` is :func:`stagewise.operators.labs.lab_summary`: one row per
    member carrying both the persistence flag inputs and the latest lab day, so
    the lab table is aggregated once and joined once.  The latest lab day and
    value ride along as ``_lab_date`` / ``_lab_value`` for the stage join.
    Current-year condition flags stay NULL for members without a row; the
    previous-year flag is coalesced to 0 (as the source does).
    """
    e = (enroll.groupBy("member_id")
               .agg(F.max(F.when(F.col("mhp").isin(*cfg.denominator_plans), 1).otherwise(0))
                     .alias("jvhl_denom_flag")))
    lab = lab_summary.select(F.col("member_id").alias("_lid"), "_any_low", "_low_first", "_low_last",
                             "_lab_date", "_lab_value")
    f = (cond_current.groupBy(F.col("member_id").alias("_fid"))
                     .agg(F.max("ckd").alias("_ckd"), F.max("esrd").alias("_esrd"),
                          F.max("aki").alias("_aki")))
    p = (cond_previous.groupBy(F.col("member_id").alias("_pid"))
                      .agg(F.max(F.coalesce(F.col("aki"), F.lit(0))).alias("_paki")))
    m = member.groupBy(F.col("member_id").alias("_mid")).agg(F.max("age").alias("_age"))

    j = (e.join(lab, F.col("member_id") == F.col("_lid"), "left")
          .join(f, F.col("member_id") == F.col("_fid"), "left")
          .join(p, F.col("member_id") == F.col("_pid"), "left")
          .join(m, F.col("member_id") == F.col("_mid"), "left"))
    has_low = F.coalesce(F.col("_any_low"), F.lit(False))
    lab_flag = F.when(has_low, 1).otherwise(0)
    two_labs = F.when(has_low & (F.datediff(F.col("_low_last"), F.col("_low_first")) >= PERSISTENCE_DAYS), 1
                      ).otherwise(0)
    esrd = F.col("_esrd") == 1
    return j.select(
        "member_id", "jvhl_denom_flag",
        lab_flag.alias("ckd_jvhl_flag"),
        two_labs.alias("ckd_jvhl_flag_2labs"),
        F.when(esrd, 0).otherwise(lab_flag).alias("ckd_no_esrd_jvhl_flag"),
        F.when(esrd, 0).otherwise(F.col("_ckd")).alias("ckd_no_esrd_flag"),
        F.col("_ckd").alias("ckd_ccw_flag"),
        F.col("_esrd").alias("esrd_flag"),
        F.col("_aki").alias(cfg.aki_current),
        F.coalesce(F.col("_paki"), F.lit(0)).alias(cfg.aki_previous),
        F.col("_age").alias("age"),
        "_lab_date", "_lab_value")


def member_rollup(enroll: DataFrame, lab_summary: DataFrame, cond_current: DataFrame,
                  cond_previous: DataFrame, member: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per enrolled member: member_id, jvhl_denom_flag, ckd_jvhl_flag,
    ckd_jvhl_flag_2labs, ckd_no_esrd_jvhl_flag, ckd_no_esrd_flag, ckd_ccw_flag,
    esrd_flag, aki_flag_<year>, aki_flag_<year-1>, age."""
    return member_rollup_wide(enroll, lab_summary, cond_current, cond_previous, member,
                              cfg).select(*member_columns(cfg))


def flag_minus_esrd_count(member_jvhl: DataFrame) -> DataFrame:
    """Lab-flagged members who are also end-stage: one pass, two conditional counts."""
    return member_jvhl.agg(
        (F.count_if(F.col("ckd_jvhl_flag") == 1)
         - F.count_if(F.col("ckd_no_esrd_jvhl_flag") == 1)).alias("n"))
