"""Data-quality checks and the QA sample.

Each check is one global (or keyed, partial) aggregate returning a small frame;
nothing is iterated on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..config import RunConfig
from ..functions.parsing import is_threshold_text
from ..sources.catalog import Inputs
from .labs import in_window
from .skew import dealt


def dx_parity(bag: DataFrame, final: DataFrame) -> DataFrame:
    """Members with a dated diagnosis (from the parsed rows, before any refinement) against the
    rows of the final frame; parity also needs every such member exactly once.  Rows without a
    member belong to nobody and are not counted."""
    tagged = (bag.where(F.col("from_date").isNotNull() & F.col("member_id").isNotNull()).select("member_id", F.lit(1).alias("_b"), F.lit(0).alias("_a"))
              .unionByName(final.select("member_id", F.lit(0).alias("_b"), F.lit(1).alias("_a"))))
    members = tagged.groupBy("member_id").agg(F.max("_b").alias("_b"), F.sum("_a").alias("_a"))
    counts = members.agg(F.coalesce(F.sum("_b"), F.lit(0)).cast("long").alias("n_before"),
                         F.coalesce(F.sum("_a"), F.lit(0)).cast("long").alias("n_after"),
                         F.coalesce(F.bool_and(F.col("_b") == F.col("_a")), F.lit(True)).alias("parity"))
    return counts.select("n_before", "n_after", "parity")


def dx_parity_of(audit: DataFrame) -> DataFrame:
    """:func:`dx_parity` from the refinement's own member aggregate (``refine_all(audit=True)``), without a second
    read of the diagnoses: members with a parsed date against members with a refined row.  Parity needs them to
    be the same members, and each one's latest date to have come through the refinement's keys unchanged."""
    before, after = F.col("parsed_date").isNotNull(), F.col("from_date").isNotNull()
    same = (before == after) & F.col("latest_date").eqNullSafe(F.col("parsed_date"))
    return audit.agg(F.count_if(before).alias("n_before"), F.count_if(after).alias("n_after"),
                     F.coalesce(F.bool_and(same), F.lit(True)).alias("parity"))


def assert_parity(counts: DataFrame) -> None:
    """Fail unless the one row of ``counts`` (n_before, n_after, parity) says parity."""
    row = counts.first()
    if not row["parity"]:
        raise AssertionError(f"refinement changed the members: {row['n_before']} -> {row['n_after']}")


def qa_both_sources_sample(member_stage: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` members (by id) having both a claim stage and a lab stage."""
    return (member_stage.where(~F.col("ckd_stage_claims").isin(C.NO_CLAIM_FLAGGED, C.NO_CLAIM)
                               & (F.col("ckd_stage_jvhl_detailed") != C.NO_LAB))
                        .orderBy(F.col("member_id").asc_nulls_last()).limit(n))


def duplicate_months(enroll: DataFrame) -> DataFrame:
    """Enrolment (member, month) pairs present more than once: they double both
    cost and exposure months downstream.  Nearly every row is a pair of its own, so
    the rows are dealt out before they are counted."""
    rows = dealt(enroll.select("member_id", F.date_format("begin_date", "yyyyMM").alias("month")))
    return (rows.groupBy("member_id", "month")
                  .agg(F.count(F.lit(1)).alias("n_rows"))
                  .where(F.col("n_rows") > 1))


def duplicate_claim_keys(df: DataFrame, what: str) -> DataFrame:
    """Claims with more than one row in a per-claim side table (category or header)."""
    return (df.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1).select(F.lit(what).alias("table"), "claim_id", "n_rows"))


def _bad_lab_texts() -> tuple[Column, Column]:
    """Whether a threshold text, and a numeric text, does not parse to a number."""
    text, num = F.col("textresult"), F.col("numericresult")
    bad_text = is_threshold_text(text) & F.translate(text, C.THRESHOLD_STRIP_CHARS, "").try_cast(
        "decimal(38,0)").isNull()
    bad_num = num.isNotNull() & (num != C.NULL_SENTINEL) & num.try_cast("decimal(38,0)").isNull()
    return F.coalesce(bad_text, F.lit(False)), F.coalesce(bad_num, F.lit(False))


def bad_lab_rows(labs: DataFrame, cfg: RunConfig) -> DataFrame:
    """The lab rows of the run's two years whose texts do not parse, as they are, and which text it is.
    The lenient cast reads them as NULL; a strict run fails on them."""
    bad_text, bad_num = _bad_lab_texts()
    marked = labs.where(in_window(cfg)).withColumns({"bad_threshold_text": bad_text, "bad_numeric_text": bad_num})
    return marked.where(F.col("bad_threshold_text") | F.col("bad_numeric_text"))


def watched_labs(labs: DataFrame, cfg: RunConfig, watch: Observation) -> DataFrame:
    """The target-test lab rows of the run's two years, with their unparseable texts counted as they pass.

    Metrics come from finished tasks; should a lost executor's tasks run again, they may count twice, so
    they are a warning, and :func:`bad_lab_rows` names the rows."""
    bad_text, bad_num = _bad_lab_texts()
    return labs.where(in_window(cfg) & (F.col("requestcpt") == cfg.target_test)).observe(
        watch, F.count_if(bad_text).alias("bad_threshold_text"), F.count_if(bad_num).alias("bad_numeric_text"))


def lab_parse_failures(labs: DataFrame) -> DataFrame:
    """Texts that pass the threshold pattern or are non-sentinel numerics but do
    not parse to a number (NULL under the lenient cast)."""
    bad_text, bad_num = _bad_lab_texts()
    return labs.agg(F.count_if(bad_text).alias("bad_threshold_text"),
                    F.count_if(bad_num).alias("bad_numeric_text"))


def data_quality(inputs: Inputs, cfg: RunConfig, observed: dict | None = None) -> DataFrame:
    """(check_name, n): the input conditions that silently change a run's results, counted in
    the tables it reads and in the target-test labs of its two years.  ``observed``: the lab
    counts of :func:`watched_labs`, which save the read of the labs."""
    def count(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("check_name"), "n")

    labs = inputs.table("labs").where(in_window(cfg) & (F.col("requestcpt") == cfg.target_test))
    if observed is None:
        failures = lab_parse_failures(labs)
    else:
        failures = labs.sparkSession.range(1).select(*[F.lit(observed.get(c, 0)).cast("long").alias(c)
                                                       for c in ("bad_threshold_text", "bad_numeric_text")])
    bad = failures.select(F.inline(F.array(
        F.struct(F.lit("unparseable threshold text").alias("check_name"), F.col("bad_threshold_text").alias("n")),
        F.struct(F.lit("unparseable numeric text").alias("check_name"), F.col("bad_numeric_text").alias("n")))))
    return (count(duplicate_months(inputs.table("enroll", cfg.year)), "duplicate enrolment months")
            .unionByName(count(duplicate_claim_keys(inputs.table("claim_category", cfg.year), "category"),
                               "claims with several category rows"))
            .unionByName(count(duplicate_claim_keys(inputs.table("inpatient_header", cfg.year), "header"),
                               "claims with several header rows"))
            .unionByName(bad))
