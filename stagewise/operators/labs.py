"""Lab results: normalisation, persistence flag, latest-day value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LAB_FLAG_LIMIT, NULL_SENTINEL, PERSISTENCE_DAYS, RunConfig
from ..functions.parsing import is_threshold_text, threshold_value, to_whole_number
from ..functions.rules import first_match
from .skew import rows_on_latest_day


def in_window(cfg: RunConfig) -> Column:
    """The analysis year and the year before, as a date range that reaches the scan."""
    d = F.col("date_servicebegin")
    return (d >= F.lit(dt.date(cfg.prev_year, 1, 1))) & (d < F.lit(dt.date(cfg.year + 1, 1, 1)))


def normalise_labs(labs: DataFrame, cfg: RunConfig) -> DataFrame:
    """Sentinel text -> NULL, numeric text -> whole number; ``all_results`` takes a
    threshold text (e.g. ``>60``) first, else the numeric value.  Keeps the
    analysis year and the year before.

    Both derived columns read the *input* ``numericresult`` text, so they are
    built in one ``select``.
    """
    num, text = F.col("numericresult"), F.col("textresult")
    return (labs.where(in_window(cfg))
                .select("member_id", "requestcpt",
                        F.when(num == NULL_SENTINEL, F.lit(None))
                         .otherwise(to_whole_number(num, cfg.strict_cast)).alias("numericresult"),
                        "textresult",
                        first_match([
                            (is_threshold_text(text), threshold_value(text, cfg.strict_cast)),
                            (num != NULL_SENTINEL, to_whole_number(num, cfg.strict_cast)),
                        ], F.lit(None).cast("decimal(38,0)")).alias("all_results"),
                        "date_servicebegin"))


def lab_summary(jvhl: DataFrame, cfg: RunConfig) -> DataFrame:
    """One pass over the target-test rows giving, per member, everything the
    persistence flag and the latest-day value need.

    (member, day) -> any numeric value below the limit, lowest value, distinct
    values; then member -> first/last low day and the latest day with a value
    (``max_by`` over days).  Both levels are partial hash aggregates, so no task
    holds a whole member, and the lab table is scanned once for both uses.
    """
    d, v = F.col("date_servicebegin"), F.col("all_results")
    per_day = (jvhl.where(F.col("requestcpt") == cfg.target_test)
                   .groupBy("member_id", "date_servicebegin")
                   .agg(F.max(F.col("numericresult") < LAB_FLAG_LIMIT).alias("_low"),
                        F.min(v).alias("all_results"),
                        F.count_distinct(v).alias("n_labs")))
    # per_day is unique per (member, day), so max_by over the day is exact; its
    # buffers are plain values, so the member aggregate stays hash-based
    valued_day = F.when(v.isNotNull(), d)
    return (per_day.groupBy("member_id")
                   .agg(F.max("_low").alias("_any_low"),
                        F.min(F.when(F.col("_low"), d)).alias("_low_first"),
                        F.max(F.when(F.col("_low"), d)).alias("_low_last"),
                        F.max(valued_day).alias("_lab_date"),
                        F.max_by(v, valued_day).alias("_lab_value"),
                        F.max_by(F.col("n_labs"), valued_day).alias("_lab_n")))


def persistence_from_summary(summary: DataFrame) -> DataFrame:
    """Members with a target test below the limit (numeric value only); the flag
    is 1 when first and last such result are at least 90 days apart."""
    span = F.datediff(F.col("_low_last"), F.col("_low_first"))
    return (summary.where(F.col("_any_low"))
                   .select("member_id",
                           F.when(span >= PERSISTENCE_DAYS, 1).otherwise(0).alias("ckd_jvhl_flag_2labs")))


def latest_from_summary(summary: DataFrame) -> DataFrame:
    """Per member, the latest day with a value: the lowest value that day (highest
    stage) and how many distinct values it had."""
    return (summary.where(F.col("member_id").isNotNull() & F.col("_lab_date").isNotNull())
                   .select("member_id", F.col("_lab_date").alias("date_servicebegin"),
                           F.col("_lab_value").alias("all_results"),
                           F.col("_lab_n").alias("n_labs")))


def rows_on_latest_lab_day(jvhl: DataFrame, cfg: RunConfig) -> DataFrame:
    """The target-test rows of each member's latest day with a value; all rows of that day, whole."""
    return rows_on_latest_day(jvhl.where(F.col("requestcpt") == cfg.target_test), "member_id", "date_servicebegin",
                              dated_by=F.col("all_results").isNotNull())


def lab_persistence_flags(jvhl: DataFrame, cfg: RunConfig) -> DataFrame:
    return persistence_from_summary(lab_summary(jvhl, cfg))


def latest_lab(jvhl: DataFrame, cfg: RunConfig) -> DataFrame:
    return latest_from_summary(lab_summary(jvhl, cfg))
