"""The staging run as one lazy DataFrame graph.

:class:`StagingRun` names every intermediate of the run as a lazily built
frame.  Nothing executes until a report is written or collected.  Frames that
several reports re-read (the member-level ``final_flags``) are cut from their
lineage once via :func:`materialize` when the run is built with
``materialize="checkpoint"`` (the default for full runs); member-grain
intermediates read by more than one section are persisted.  Query-by-query use
keeps everything lazy (``"none"``).  With ``tables`` the shared frames are named
tables instead, each written and committed once a run, so that a run started
again goes on behind the last one it finished.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import RunConfig
from ..operators import costs, diagnoses, labs, members, quality, staging
from ..session import materialize
from ..sources.catalog import Inputs
from ..sources.named import NamedTables


class StagingRun:
    """The run's named frames, built lazily on first access.

    labs_normalised, lab_summary, lab_flags, latest_lab      lab side
    member_wide, member_jvhl                                 member roll-up
    dx_parsed(distinct), dx_bag, dx_refined, latest_dx, dx_final   diagnosis side
    member_stage, final_flags                                one row per member
    claim_prep, member_cost(...), cost_by_stage(...), cost_battery   cost side
    """

    def __init__(self, inputs: Inputs, cfg: RunConfig | None = None, materialize_mode: str = "none",
                 tables: NamedTables | None = None):
        self.inputs = inputs
        self.cfg = cfg or RunConfig()
        self.mode = materialize_mode
        self.tables = tables
        self._cached: list[DataFrame] = []

    def _t(self, name: str, year: int | None = None) -> DataFrame:
        return self.inputs.table(name, year)

    def _keep(self, name: str, build: Callable[[], DataFrame], watch: Observation | None = None) -> DataFrame:
        """Member-grain intermediates re-read by several sections: named tables, or
        cached (lost blocks are recomputed from lineage) when the run materialises."""
        if self.tables is not None:
            return self.tables.frame(name, build, watch)
        if self.mode == "none":
            return build()
        kept = materialize(build(), "persist")
        self._cached.append(kept)
        return kept

    def release(self) -> None:
        """Drop the cached member-grain intermediates (after the report is written)."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()

    # -- labs ----------------------------------------------------------------
    @cached_property
    def labs_normalised(self) -> DataFrame:
        return labs.normalise_labs(self._t("labs"), self.cfg)

    @cached_property
    def lab_summary(self) -> DataFrame:
        if self.tables is None:
            return self._keep("lab_summary", lambda: labs.lab_summary(self.labs_normalised, self.cfg))
        # texts that do not parse are counted in the pass that summarises the labs
        watch = Observation("lab_parse_failures")
        return self._keep("lab_summary", lambda: labs.lab_summary(
            labs.normalise_labs(quality.watched_labs(self._t("labs"), self.cfg, watch), self.cfg), self.cfg), watch)

    @property
    def lab_parse_failures(self) -> dict | None:
        """The unparseable texts counted while the lab summary was written; None in a run without named tables."""
        if self.tables is None:
            return None
        self.lab_summary
        return self.tables.metrics("lab_summary")

    @cached_property
    def lab_flags(self) -> DataFrame:
        return labs.persistence_from_summary(self.lab_summary)

    @cached_property
    def latest_lab(self) -> DataFrame:
        return labs.latest_from_summary(self.lab_summary)

    # -- members -------------------------------------------------------------
    @cached_property
    def member_wide(self) -> DataFrame:
        y, p = self.cfg.year, self.cfg.prev_year
        return members.member_rollup_wide(self._t("enroll", y), self.lab_summary,
                                          self._t("condition_flags", y), self._t("condition_flags", p),
                                          self._t("member", y), self.cfg)

    @cached_property
    def member_jvhl(self) -> DataFrame:
        return self.member_wide.select(*members.member_columns(self.cfg))

    # -- diagnoses -----------------------------------------------------------
    def dx_parsed(self, distinct: bool = True) -> DataFrame:
        y, p = self.cfg.year, self.cfg.prev_year
        return diagnoses.parse_dx(self._t("dx_long", y), self._t("dx_long", p),
                                  self._t("claim_headers"), distinct=distinct)

    @cached_property
    def dx_bag(self) -> DataFrame:
        """Parsed diagnoses without the whole-row de-duplication (max-only use)."""
        return self.dx_parsed(distinct=False)

    @cached_property
    def latest_dx(self) -> DataFrame:
        """Latest diagnosis before refinement (same aggregate as the refinement)."""
        return self.dx_refined.select("member_id", F.col("latest_date").alias("from_date"),
                                      F.col("latest_num").alias("dx_num"))

    @cached_property
    def dx_audit(self) -> DataFrame:
        """The refinement with each member's latest date as parsed: one read of the diagnoses gives
        both the refined rows and the parity check."""
        return self._keep("dx_audit", lambda: diagnoses.refine_all(self.dx_bag, audit=True))

    @cached_property
    def dx_refined(self) -> DataFrame:
        if self.tables is None and self.mode == "none":
            return diagnoses.refine_all(self.dx_bag)
        return self.dx_audit.where(F.col("from_date").isNotNull()).drop("parsed_date")

    @cached_property
    def dx_final(self) -> DataFrame:
        return self.dx_refined.select("member_id", "dx_num", "from_date")

    @cached_property
    def dx_parity(self) -> DataFrame:
        return quality.dx_parity_of(self.dx_audit)

    # -- stage -------------------------------------------------------------
    @cached_property
    def member_stage(self) -> DataFrame:
        return staging.member_stage(self.member_wide, self.dx_final, self.cfg)

    @cached_property
    def final_flags(self) -> DataFrame:
        if self.tables is not None:
            return self.tables.frame("final_flags", lambda: staging.final_flags(self.member_stage, self.cfg))
        return materialize(staging.final_flags(self.member_stage, self.cfg), self.mode)

    # -- cost ----------------------------------------------------------------
    @cached_property
    def claim_prep(self) -> DataFrame:
        y = self.cfg.year
        # read once (by the single-pass cost battery), so no lineage cut is needed
        return costs.claim_cost(self._t("claims", y), self._t("claim_category", y),
                                self._t("inpatient_header", y), self.cfg)

    def member_cost(self, category: str = "all", medical: str = "both", dual: str = "both") -> DataFrame:
        y = self.cfg.year
        return costs.member_cost(self._t("enroll", y), self._t("member", y), self.claim_prep,
                                 self.final_flags, category, medical, dual)

    def cost_by_stage(self, category: str = "all", medical: str = "both", dual: str = "both") -> DataFrame:
        return costs.cost_by_stage(self.member_cost(category, medical, dual))

    @cached_property
    def cost_battery(self) -> DataFrame:
        y = self.cfg.year
        return costs.cost_battery(self._t("enroll", y), self._t("member", y), self.claim_prep,
                                  self.final_flags, self.cfg)
