"""Frequencies, crosstabs, distributions and the stacked report batteries.

``frequency`` is the single-table helper.  Batteries of many tables over the
same frame use :func:`stacked_frequencies`: each input row (or each row of a
pre-aggregated cuboid) emits one record per table whose filter it passes, and
one aggregate answers every table.  Each table's dimensions are explicit in the
record, so a NULL dimension value is never confused with "not a dimension of
this table".
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import sqltext as Q
from ..functions.predicates import apply_where
from .ranks import percentile_of, ranked_values
from .skew import lookup, side_by_side


def _order(dims: Sequence[str]) -> list[Column]:
    return [F.col(d).asc_nulls_last() for d in dims]


def frequency(df: DataFrame, dims: Sequence[str | Column], where: Column | str | None = None,
              aggs: Sequence[Column] = (), name: str = "n", count: Column | None = None,
              ordered: bool = True) -> DataFrame:
    """``dims..., <name>, aggs...`` grouped by ``dims`` (NULL is its own group),
    ordered by ``dims`` ascending with NULLs last.  ``count`` replaces
    ``count(*)`` (e.g. ``F.count_distinct("member_id")``).  A dimension may be an
    expression (give it an alias)."""
    dims = list(dims)
    out = (apply_where(df, where).groupBy(*dims)
           .agg((count if count is not None else F.count(F.lit(1))).alias(name), *aggs))
    return out.orderBy(*_order(out.columns[:len(dims)])) if ordered else out


def count_where(df: DataFrame, where: Column | str | None = None,
                agg: Column | None = None) -> DataFrame:
    """One-row frame ``n``: ``count(*)`` (or ``agg``) over the filtered rows."""
    return apply_where(df, where).agg((agg if agg is not None else F.count(F.lit(1))).alias("n"))


def count_value(df: DataFrame, where: Column | str | None = None, agg: Column | None = None):
    """The scalar of :func:`count_where` (a global aggregate; one row reaches the driver)."""
    return count_where(df, where, agg).first()[0]


def distinct_values(df: DataFrame, col: str, where: Column | str | None = None) -> DataFrame:
    """Distinct values of ``col`` ordered ascending, NULL last."""
    return apply_where(df, where).select(col).distinct().orderBy(F.col(col).asc_nulls_last())


def category_list(df: DataFrame, col: str, where: Column | str | None = None, most: int = 10_000) -> list:
    """Python list of the distinct values; fails beyond ``most`` of them."""
    found = distinct_values(df, col, where).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} distinct values; use distinct_values")
    return [r[0] for r in found]


def percentile_name(p: float) -> str:
    return f"prcntl_{int(round(p * 100))}"


def distribution(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """variable, by..., mean, min, prcntl_1 .. prcntl_99 (exact, interpolated), max.

    Any numeric column, also one with as many values as rows: ranks are found
    by :mod:`~stagewise.operators.ranks`, so no group's values meet in a task.  The
    mean divides an exact sum (floating-point columns aside).  NULL is a group
    of its own in ``by`` and no value in ``col``; a group without values has
    NULLs.
    """
    ranked = ranked_values(df, col, by, C.PERCENTILES)
    return ranked.select(F.lit(col).alias("variable"), *by, (F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))).alias("mean"), F.col("_min").alias("min"),
                         *[percentile_of(i, p).alias(percentile_name(p)) for i, p in enumerate(C.PERCENTILES)],
                         F.col("_max").alias("max"))


# -- stacked batteries ---------------------------------------------------------

@dataclass(frozen=True)
class Table:
    """One report table: its id, title, dimension columns and an optional
    filter written as a SQL boolean expression over the input columns."""
    table_id: int
    title: str
    dims: tuple[str, ...]
    where: str | None = None


def stacked_frequencies(df: DataFrame, tables: Sequence[Table], width: int | None = None,
                        weight: str | None = None, ordered: bool = True) -> DataFrame:
    """Many frequency tables in one pass, long form:
    table_id, title, var1, val1, ..., varW, valW, n  (values as strings).

    Each input row emits one record per table whose filter holds (a single
    ``inline`` generator declared as SQL text), and one aggregate counts them.
    ``weight``: sum this column instead of counting rows (for a pre-aggregated
    cuboid).  Output ordered by table then values, NULLs last.
    """
    width = width or max(len(t.dims) for t in tables)
    w = f"CAST({Q.ident(weight)} AS BIGINT)" if weight else "CAST(1 AS BIGINT)"
    rows = []
    for t in tables:
        fields = [("table_id", Q.lit(t.table_id)), ("title", Q.lit(t.title))]
        for i in range(width):
            if i < len(t.dims):
                fields += [(f"var{i + 1}", Q.lit(t.dims[i])),
                           (f"val{i + 1}", f"CAST({Q.ident(t.dims[i])} AS STRING)")]
            else:
                fields += [(f"var{i + 1}", "CAST(NULL AS STRING)"), (f"val{i + 1}", "CAST(NULL AS STRING)")]
        fields.append(("_w", w))
        rows.append((t.where, fields))
    stacked = df.select(Q.unpivot_rows(rows))
    keys = ["table_id", "title"] + [c for i in range(width) for c in (f"var{i + 1}", f"val{i + 1}")]
    out = stacked.groupBy(*keys).agg(F.sum("_w").alias("n"))
    return out.orderBy(*_order(keys)) if ordered else out


def stacked_distinct(df: DataFrame, tables: Sequence[Table], key: str, name: str = "n_members",
                     width: int | None = None, ordered: bool = True) -> DataFrame:
    """As :func:`stacked_frequencies` over raw rows, and beside ``n`` each cell's exact number of
    distinct ``key`` values, in one pass over ``df``.

    Distinct counts cannot be added up over cells, so cells carry bitmaps.  Rows are
    counted by (dimensions, key), keys are numbered (consecutive within a task's
    sorted keys, so their bits lie close), and each combination of dimensions holds
    a bitmap for every 32,768 numbers; a table's cell is the OR of its
    combinations', and the bits are counted last.  A NULL key counts as a row and
    as no member.  A task holds one bitmap of 4 KB for each of its cells.
    """
    width = width or max(len(t.dims) for t in tables)
    dims = sorted({d for t in tables for d in t.dims})
    flags = {t.where: f"_where{i}" for i, t in enumerate(tables) if t.where is not None}
    marks = [F.coalesce(F.expr(w), F.lit(False)).alias(f) for w, f in flags.items()]
    base = df.groupBy(*dims, *marks, key).agg(F.count(F.lit(1)).alias("_n"))
    keys = base.where(F.col(key).isNotNull()).select(key).distinct().sortWithinPartitions(key)
    numbers = keys.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_number"))
    numbered = base.join(numbers, F.col(key) == F.col("_key"), "left")
    cells = (numbered.groupBy(*dims, *flags.values(), F.bitmap_bucket_number(F.col("_number")).alias("_bucket"))
                     .agg(F.sum("_n").alias("_n"), F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_number"))).alias("_bits")))
    rows = []
    for t in tables:
        fields = [("table_id", Q.lit(t.table_id)), ("title", Q.lit(t.title))]
        for i in range(width):
            dim = t.dims[i] if i < len(t.dims) else None
            fields += [(f"var{i + 1}", Q.lit(dim) if dim else "CAST(NULL AS STRING)"),
                       (f"val{i + 1}", f"CAST({Q.ident(dim)} AS STRING)" if dim else "CAST(NULL AS STRING)")]
        rows.append((flags.get(t.where), [*fields, ("_bucket", "_bucket"), ("_n", "_n"), ("_bits", "_bits")]))
    names = ["table_id", "title"] + [c for i in range(width) for c in (f"var{i + 1}", f"val{i + 1}")]
    merged = (cells.select(Q.unpivot_rows(rows)).groupBy(*names, "_bucket")
                   .agg(F.sum("_n").alias("_n"), F.bitmap_or_agg("_bits").alias("_bits")))
    members = F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_bits"))
    out = merged.groupBy(*names).agg(F.sum("_n").alias("n"), F.coalesce(F.sum(members), F.lit(0)).alias(name))
    return out.orderBy(*_order(names)) if ordered else out


def cuboid(df: DataFrame, dims: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Row counts over every combination of ``dims`` present (column ``n``).

    Its size is bounded by label combinations, not by rows; partial aggregation
    makes the shuffle carry at most one row per combination per map task.
    """
    return df.groupBy(*dims, *extra).agg(F.count(F.lit(1)).alias("n"))


# -- report batteries over the member-level flags ------------------------------

STAGE_REPORT_VARS = ("ckd_stage_comb_all", "ckd_stage_comb_5andesrd",
                     "ckd_stage_comb_w3unsp", "ckd_stage_comb_5cat")

CROSSTAB_VARS = ("ckd_jvhl_flag", "ckd_stage_jvhl", "ckd_jvhl_flag_2labs",
                 "ckd_stage_jvhl_detailed", "ckd_stage_comb_all", "ckd_stage_comb_5andesrd",
                 "ckd_stage_claims", "ckd_stage_comb_w3unsp", "ckd_stage_comb_5cat")

COHORTS = ("adults", "adults in JVHL denominator")


def crosstab_partners(cfg: C.RunConfig) -> dict[str, list[tuple[str, ...]]]:
    return {
        "ckd_jvhl_flag": [("ckd_ccw_flag",), ("ckd_jvhl_flag_2labs",),
                          (cfg.aki_current, cfg.aki_previous)],
        "ckd_stage_jvhl_detailed": [("ckd_stage_claims",), ("ckd_stage_claims", "ckd_stage_comb_all")],
        "ckd_stage_claims": [("esrd_flag", "ckd_ccw_flag")],
    }


def stage_frequency_tables(cfg: C.RunConfig) -> list[Table]:
    return [Table(i, f"{v} for {cfg.year}", (v,)) for i, v in enumerate(STAGE_REPORT_VARS, start=1)]


def crosstab_tables(cfg: C.RunConfig, adult: str, denom: str) -> list[Table]:
    """The 2 cohorts x (9 one-way + 6 multi-way) tables, in report order.

    ``adult`` / ``denom``: SQL conditions for "adult" and "in the lab-plan
    denominator" over the frame the battery reads.
    """
    partners = crosstab_partners(cfg)
    tables, tid = [], 0
    for cohort in COHORTS:
        where = adult if cohort == "adults" else f"({adult}) AND ({denom})"
        for v in CROSSTAB_VARS:
            tid += 1
            tables.append(Table(tid, f"{v} for {cohort} in {cfg.year}", (v,), where))
            for p in partners.get(v, []):
                tid += 1
                label = (", " if cfg.aki_current in p else ",").join(p)
                tables.append(Table(tid, f"{v} and {label} crosstab for {cohort} in {cfg.year}",
                                    (v, *p), where))
    return tables


def crosstab_dims(cfg: C.RunConfig) -> list[str]:
    dims = list(CROSSTAB_VARS)
    for ps in crosstab_partners(cfg).values():
        for p in ps:
            dims += [d for d in p if d not in dims]
    return dims


def _adult() -> Column:
    return F.coalesce(F.col("age") >= C.ADULT_AGE, F.lit(False)).alias("_adult")


def _differ() -> Column:
    return (F.col("ckd_stage_jvhl_detailed") != F.col("ckd_stage_claims")).alias("_differ")


def report_dims(cfg: C.RunConfig) -> list[str]:
    """Every member-level dimension any report table groups by."""
    dims = set(crosstab_dims(cfg)) | set(STAGE_REPORT_VARS) | {"jvhl_denom_flag"}
    dims |= {d for t in qa_member_tables(cfg) for d in t.dims}
    return sorted(dims)


def report_cuboid(final_flags: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """Member counts over every combination of the report dimensions plus the
    adult and lab-vs-claim-differ markers.  One pass over the member flags
    answers the 4 stage tables, the 30 cohort tables and the 9 member QA
    tables; its size is bounded by label combinations, not by members."""
    return cuboid(final_flags, report_dims(cfg), extra=[_adult(), _differ()])


def stage_frequencies(final_flags: DataFrame, cfg: C.RunConfig,
                      base: DataFrame | None = None) -> DataFrame:
    """The four one-way stage tables over all members (long form).
    ``base``: a :func:`report_cuboid` to read instead of the member flags."""
    if base is None:
        base = cuboid(final_flags, STAGE_REPORT_VARS)
    return stacked_frequencies(base, stage_frequency_tables(cfg), weight="n")


def crosstab_battery(final_flags: DataFrame, cfg: C.RunConfig,
                     base: DataFrame | None = None) -> DataFrame:
    """All 30 cohort frequency/crosstab tables from one cuboid of the member flags.

    The cuboid carries every report dimension, the adult flag (NULL age -> not
    adult) and the plan-denominator flag; each table then sums cuboid counts.
    """
    if base is None:
        base = cuboid(final_flags, crosstab_dims(cfg), extra=[_adult(), F.col("jvhl_denom_flag")])
    tables = crosstab_tables(cfg, "_adult", "jvhl_denom_flag = 1")
    return stacked_frequencies(base, tables, weight="n")


def monthly_counts(final_flags: DataFrame) -> DataFrame:
    """Members by ``yyyyMM`` of their claim-stage date beside members by lab-stage
    date; a month missing on one side has NULL there (full-outer semantics),
    and the NULL month (no date) is a row of its own.  One aggregate, no join.
    """
    recs = F.array(
        F.struct(F.date_format("ckd_stage_claims_date", "yyyyMM").alias("month"),
                 F.lit(1).alias("is_claim")),
        F.struct(F.date_format("ckd_stage_jvhl_date", "yyyyMM").alias("month"),
                 F.lit(0).alias("is_claim")))
    stacked = final_flags.select(F.inline(recs))
    return (stacked.groupBy("month")
                   .agg(F.sum(F.when(F.col("is_claim") == 1, 1)).alias("ckd_stage_claims_date"),
                        F.sum(F.when(F.col("is_claim") == 0, 1)).alias("ckd_jvhl_claims_date"))
                   .orderBy(F.col("month").asc_nulls_last()))


def claim_member_tables() -> list[Table]:
    adult = f"age >= {C.ADULT_AGE}"
    return [Table(1, "claims by category", ("fasc_cat_adj",)),
            Table(2, "claims by category, adults", ("fasc_cat_adj",), adult),
            Table(3, "claims by category and stage", ("fasc_cat_adj", "ckd_stage_comb_5cat")),
            Table(4, "claims by category and stage, adults in plan denominator", ("fasc_cat_adj", "ckd_stage_comb_5cat"),
                  f"{adult} AND jvhl_denom_flag = 1"),
            Table(5, "claims by claim stage", ("ckd_stage_claims",)),
            Table(6, "claims by all combined stages", ("ckd_stage_comb_all",))]


def claim_member_battery(claim_prep: DataFrame, final_flags: DataFrame) -> DataFrame:
    """Claims and distinct members by category and stage, six tables in one pass over the claims.

    Claims are counted by (member, category) before they meet the member's flags,
    so a member with a third of all claims is a few rows.
    """
    claims = claim_prep.select("member_id", "fasc_cat_adj")
    flags = final_flags.select(F.col("member_id").alias("_mid"), "age", "jvhl_denom_flag", "ckd_stage_claims", "ckd_stage_comb_all", "ckd_stage_comb_5cat")
    return stacked_distinct(lookup(claims, flags, "member_id", "_mid", flags.columns[1:]), claim_member_tables(), "member_id")


def monthly_stages(final_flags: DataFrame) -> DataFrame:
    """Members by month and stage of their claims beside those by month and stage of their labs."""
    month = lambda c: F.date_format(c, "yyyyMM").alias("month")
    claims = frequency(final_flags, [month("ckd_stage_claims_date"), F.col("ckd_stage_claims").alias("stage")], name="n_claims", ordered=False)
    labs = frequency(final_flags, [month("ckd_stage_jvhl_date"), F.col("ckd_stage_jvhl_detailed").alias("stage")], name="n_labs", ordered=False)
    return side_by_side(claims, labs, ["month", "stage"]).orderBy(*_order(["month", "stage"]))


# -- QA frequencies ----------------------------------------------------------

def qa_lab_tables() -> list[Table]:
    """Over the target test's rows."""
    return [Table(1, "numericresult by all_results (target test)", ("numericresult", "all_results")),
            Table(2, "textresult by all_results (target test)", ("textresult", "all_results"))]


def qa_member_tables(cfg: C.RunConfig) -> list[Table]:
    differ = "ckd_stage_jvhl_detailed <> ckd_stage_claims"
    specs = [
        ("jvhl_denom_flag", "ckd_jvhl_flag", "ckd_jvhl_flag_2labs", "ckd_no_esrd_jvhl_flag"),
        ("ckd_jvhl_flag", "ckd_no_esrd_jvhl_flag"),
        ("ckd_jvhl_flag", "ckd_jvhl_flag_2labs"),
        ("ckd_stage_jvhl", "ckd_stage_jvhl_detailed"),
        ("ckd_stage_jvhl_detailed", "ckd_stage_claims"),
        ("recent_stage", "ckd_stage"),
        ("ckd_stage_jvhl_detailed", "ckd_ccw_lab_flag"),
        ("ckd_stage_claims", "ckd_ccw_lab_flag"),
        ("ckd_stage_comb_all", "ckd_stage_comb_w3unsp"),
    ]
    out = []
    for i, dims in enumerate(specs, start=4):
        where = differ if dims == ("recent_stage", "ckd_stage") else None
        title = " by ".join(dims) + (" where lab and claim stage differ" if where is not None else "")
        out.append(Table(i, title, dims, where))
    return out


def qa_frequencies(labs_normalised: DataFrame, latest_lab: DataFrame, final_flags: DataFrame,
                   cfg: C.RunConfig, width: int = 4, base: DataFrame | None = None) -> DataFrame:
    """The QA frequency prints as one long frame (12 tables, three sources).
    ``base``: a :func:`report_cuboid` for the member tables.  The lab rows are
    filtered to the target test (pushed to the scan) and counted by their three
    values before the tables are stacked."""
    lab_base = cuboid(labs_normalised.where(F.col("requestcpt") == cfg.target_test),
                      ["all_results", "numericresult", "textresult"])
    labs_part = stacked_frequencies(lab_base, qa_lab_tables(), width, weight="n", ordered=False)
    n_labs = stacked_frequencies(latest_lab, [Table(3, "n_labs on the latest lab day", ("n_labs",))],
                                 width, ordered=False)
    mt = qa_member_tables(cfg)
    if base is None:
        base = cuboid(final_flags, sorted({d for t in mt for d in t.dims}), extra=[_differ()])
    mt = [Table(t.table_id, t.title, t.dims, "_differ" if t.where is not None else None)
          for t in mt]
    members_part = stacked_frequencies(base, mt, width, weight="n", ordered=False)
    keys = ["table_id", "title"] + [c for i in range(width) for c in (f"var{i + 1}", f"val{i + 1}")]
    return labs_part.unionByName(n_labs).unionByName(members_part).orderBy(*_order(keys))
