"""Claim cost, member-month exposure and cost per member-year by stage.

Shapes chosen for scale:

* claim lines are reduced to the claim and header rows to the claim before
  the joins; the final (claim, member, category) aggregate runs on the join's
  claim partitioning.  Duplicate category or header rows multiply summed line
  amounts exactly as the row-level join does;
* exposure never joins at row level: enrolment rows and claim rows are unioned
  and partially aggregated per (member, month), then per member; the adult
  filter becomes a member-grain multiplicity joined 1:1;
* the whole battery (3 populations x category filters x 6 stage schemes) is one
  member aggregate with conditional sums, one small stage cuboid, and one
  unpivot - instead of one rebuild plus six group-bys per report table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import sqltext as Q
from ..functions.predicates import adults, category_where, flag_where
from .skew import dealt, with_totals

MONEY_SUM = "decimal(38,2)"
YEARS = "decimal(20,6)"
YEARS_SUM = "decimal(38,6)"


def claim_cost(claims: DataFrame, category: DataFrame, ip_header: DataFrame,
               cfg: C.RunConfig) -> DataFrame:
    """One row per (claim, member, category): latest line date; inpatient cost is
    the largest header amount (NULL if none), any other category the sum of the
    line amounts; the category folded to five names (original spelling) + other.
    Lines with status 1 (or NULL status) are dropped.
    """
    lines = (claims.where(F.col("claim_status") != C.EXCLUDED_CLAIM_STATUS)
                   .groupBy("claim_id", "member_id")
                   .agg(F.max("from_date").alias("from_date"),
                        F.sum("allowed_amt").alias("_line_amt")))
    ip = (ip_header.groupBy(F.col("claim_id").alias("_iid"))
                   .agg(F.max("allowed_amount").alias("_ip_amt"),
                        F.count(F.lit(1)).alias("_n_ip")))
    cat = category.select(F.col("claim_id").alias("_cid"), "fasc_cat")   # raw rows, duplicates kept
    j = (lines.join(cat, F.col("claim_id") == F.col("_cid"), "inner")
              .join(ip, F.col("claim_id") == F.col("_iid"), "left"))
    # j is partitioned by claim_id, so this aggregate needs no further shuffle;
    # summing over the category rows applies their multiplicity, and each line
    # total counts once per header row, as in the row-level join
    header_rows = F.coalesce(F.col("_n_ip"), F.lit(1)).cast("decimal(20,0)")
    per = (j.groupBy("claim_id", "member_id", "fasc_cat")
            .agg(F.max("from_date").alias("from_date"),
                 F.sum(F.col("_line_amt") * header_rows).alias("_sum_amt"),
                 F.max("_ip_amt").alias("_ip_amt")))
    lower = F.lower(F.col("fasc_cat"))
    amount = (F.when(lower == C.CAT_INPATIENT, F.col("_ip_amt"))
               .otherwise(F.col("_sum_amt"))).cast(MONEY_SUM)
    adj = F.when(lower.isin(*C.NAMED_CATEGORIES), F.col("fasc_cat")).otherwise(F.lit(C.CAT_OTHER))
    out = per.select("claim_id", "member_id", "from_date", amount.alias("allowed_amt"),
                     adj.alias("fasc_cat_adj"))
    return out


def _month(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def _years(n_month: Column) -> Column:
    """months / 12 as a fixed-point number with six decimals (5/12 -> 0.416667)."""
    return (n_month.cast(YEARS) / F.lit(12)).cast(YEARS)


def months_on_rows(enroll: DataFrame, member: DataFrame, medical: str = "both", dual: str = "both") -> DataFrame:
    """member_id, month, n_month: every adult enrolment row of the population with its member's number of
    rows (the window count, as :func:`~stagewise.operators.skew.with_totals`).  Repeated months and
    repeated member rows count again."""
    adult = member.where(adults(F.col("age")) & F.col("member_id").isNotNull()).select(F.col("member_id").alias("_mid"))
    rows = enroll.where(flag_where(F.col("medical_flag"), medical) & flag_where(F.col("dual_flag"), dual))
    rows = rows.join(adult, F.col("member_id") == F.col("_mid")).select("member_id", _month(F.col("begin_date")).alias("month"))
    return with_totals(rows, ["member_id"], [F.count(F.lit(1)).alias("n_month")])


def _category_key(category: str) -> str:
    return "c_" + category.replace(" ", "_")


def member_measures(enroll: DataFrame, member: DataFrame, claim_prep: DataFrame,
                    populations: dict[str, tuple[str, str]],
                    costs_needed: set[tuple[str, str]]) -> DataFrame:
    """Per member: ``<pop>__months`` and ``<pop>__<c_category>`` over adult
    enrolment months, for several populations (medical, dual flag filters) and
    claim categories at once.

    Semantics are those of joining enrolment months to the member table (adults
    only) and then to the claims of the same member and month, summing claim
    cost and counting months.  Evaluated without any row-level join:

    1. enrolment rows and claim rows (NULL months excluded: they never match)
       are unioned and partially aggregated per (member, month): enrolment rows
       per population, claim cost per category; enrolment, nearly one row per
       group, is dealt out first, so that no task holds the groups of a split;
    2. a member aggregate multiplies each month's cost by its enrolment rows
       (duplicate months count twice, as the join does) and sums;
    3. the member-grain adult multiplicity (adult rows in the member table) is
       joined 1:1 and scales both months and cost.

    Every shuffle carries partial aggregates, so a member (or member-month)
    holding a third of all rows never lands whole in one task.
    """
    pop_names = list(populations)
    cats = sorted({cat for _, cat in costs_needed})
    money_null = F.lit(None).cast(MONEY_SUM)
    e = dealt(enroll.select(
        "member_id", _month(F.col("begin_date")).alias("month"),
        *[(flag_where(F.col("medical_flag"), med) & flag_where(F.col("dual_flag"), dual))
          .alias(name) for name, (med, dual) in populations.items()]))
    e = e.withColumns({"_amt": money_null, "_cat": F.lit(None).cast("string")})
    c = claim_prep.where(F.col("from_date").isNotNull()).select(
        "member_id", _month(F.col("from_date")).alias("month"),
        *[F.lit(False).alias(name) for name in pop_names],
        F.col("allowed_amt").cast(MONEY_SUM).alias("_amt"), F.col("fasc_cat_adj").alias("_cat"))
    per_month = (e.unionByName(c).groupBy("member_id", "month")
                 .agg(*[F.count_if(F.col(name)).alias(f"_{name}_n") for name in pop_names],
                      *[F.sum(F.when(category_where(F.col("_cat"), cat), F.col("_amt")))
                        .alias(f"_{_category_key(cat)}") for cat in cats]))
    aggs = [F.sum(f"_{name}_n").alias(f"_{name}_months") for name in pop_names]
    for name, cat in sorted(costs_needed):
        n = F.col(f"_{name}_n")
        aggs.append(F.sum(F.when(n > 0, F.col(f"_{_category_key(cat)}") * n.cast("decimal(10,0)")))
                    .cast(MONEY_SUM).alias(f"_{name}__{_category_key(cat)}"))
    per_member = per_month.groupBy("member_id").agg(*aggs)
    adult = (member.groupBy(F.col("member_id").alias("_mid"))
                   .agg(F.count_if(adults(F.col("age"))).alias("_mult"))
                   .where(F.col("_mult") > 0))
    mult = F.col("_mult")
    out = [(F.col(f"_{name}_months") * mult).alias(f"{name}__months") for name in pop_names]
    out += [(F.col(f"_{name}__{_category_key(cat)}") * mult.cast("decimal(10,0)")).cast(MONEY_SUM)
            .alias(f"{name}__{_category_key(cat)}") for name, cat in sorted(costs_needed)]
    return (per_member.join(adult, F.col("member_id") == F.col("_mid"), "inner")
                      .select("member_id", *out))


def member_cost(enroll: DataFrame, member: DataFrame, claim_prep: DataFrame,
                final_flags: DataFrame, category: str = "all", medical: str = "both",
                dual: str = "both") -> DataFrame:
    """Per eligible member: stage variables, cost in enrolled months, member-years.

    Cost counts only claims whose service month is an enrolled month; members
    with no such claim keep NULL cost but still add their years.
    """
    pm = (member_measures(enroll, member, claim_prep, {"p": (medical, dual)}, {("p", category)})
          .where(F.col("p__months") > 0))
    f = final_flags.select(F.col("member_id").alias("_fid"), "ckd_no_esrd_flag",
                           *C.COST_STAGE_VARS)
    return (pm.join(f, F.col("member_id") == F.col("_fid"), "left")
            .select("member_id", *C.COST_STAGE_VARS, "ckd_no_esrd_flag",
                    F.col(f"p__{_category_key(category)}").alias("cost_sum"),
                    _years(F.col("p__months")).alias("n_year")))


def _ratio(total: Column, years: Column) -> Column:
    return F.try_divide(total.cast("double"), years.cast("double"))


def cost_by_stage(member_cost_df: DataFrame) -> DataFrame:
    """Six stage schemes stacked long: stage_var, stage, total_cost, n_year,
    cost_per_bene_yr.  The claim-stage scheme counts only members flagged by
    claims without end-stage.  One unpivot + one aggregate."""
    rows = [("ckd_no_esrd_flag = 1" if v == "ckd_stage_claims" else None,
             [("stage_var", Q.lit(v)), ("stage", Q.ident(v))]) for v in C.COST_STAGE_VARS]
    stacked = member_cost_df.select(Q.unpivot_rows(rows), "cost_sum", "n_year")
    return (stacked.groupBy("stage_var", "stage")
                   .agg(F.sum("cost_sum").cast(MONEY_SUM).alias("total_cost"),
                        F.sum("n_year").cast(YEARS_SUM).alias("n_year"))
                   .select("stage_var", "stage", "total_cost", "n_year",
                           _ratio(F.col("total_cost"), F.col("n_year")).alias("cost_per_bene_yr")))


# -- the battery (M4) ---------------------------------------------------------

_POPULATIONS = {("both", "both"): "p_all", ("Y", "N"): "p_med_nodual", ("both", "Y"): "p_dual"}


def battery_titles(cfg: C.RunConfig) -> list[str]:
    base = "Cost per bene year by stage"
    out = []
    for cat, med, dual in C.COST_BATTERY:
        if (cat, med, dual) == ("all", "both", "both"):
            out.append(f"{base} for {cfg.year}")
        elif (med, dual) == ("both", "both"):
            out.append(f"{base} for {cat} FASC category for {cfg.year}")
        elif dual == "Y" and med == "both":
            out.append(f"{base} where dual_flag='Y' for {cfg.year}")
        else:
            out.append(f"{base} where med_flag='{med}' and dual_flag='{dual}' for {cfg.year}")
    return out


def cost_battery(enroll: DataFrame, member: DataFrame, claim_prep: DataFrame,
                 final_flags: DataFrame, cfg: C.RunConfig,
                 battery: tuple = C.COST_BATTERY) -> DataFrame:
    """All cost-by-stage tables of the battery in one pass.

    1. :func:`member_measures` for the three populations and every category
       filter the battery needs (one union, two partial aggregates, one
       member-grain join);
    2. joined 1:1 to the stage variables and reduced to a cuboid over the six
       stage schemes (bounded by label combinations, not by members);
    3. one unpivot over (table x scheme) and one aggregate.

    Output: table_id, title, fasc_cat, med_flag, dual_flag, stage_var, stage,
    total_cost, n_year, cost_per_bene_yr.
    """
    pops = sorted({(med, dual) for _, med, dual in battery})
    pop_name = {p: _POPULATIONS.get(p, f"p_{p[0]}_{p[1]}") for p in pops}
    needed = {(pop_name[(med, dual)], cat) for cat, med, dual in battery}
    per_member = member_measures(enroll, member, claim_prep,
                                 {pop_name[p]: p for p in pops}, needed)

    f = final_flags.select(F.col("member_id").alias("_fid"), "ckd_no_esrd_flag", *C.COST_STAGE_VARS)
    pm = per_member.join(f, F.col("member_id") == F.col("_fid"), "left")
    measures = []
    for name in pop_name.values():
        months = F.col(f"{name}__months")
        measures.append(F.sum(F.when(months > 0, 1)).alias(f"{name}__members"))
        measures.append(F.sum(F.when(months > 0, _years(months))).cast(YEARS_SUM).alias(f"{name}__years"))
    for name, cat in sorted(needed):
        col = f"{name}__{_category_key(cat)}"
        measures.append(F.sum(col).cast(MONEY_SUM).alias(col))
    cuboid = pm.groupBy("ckd_no_esrd_flag", *C.COST_STAGE_VARS).agg(*measures)

    titles = battery_titles(cfg) if battery == C.COST_BATTERY else [str(b) for b in battery]
    rows = []
    for tid, ((cat, med, dual), title) in enumerate(zip(battery, titles), start=1):
        name = pop_name[(med, dual)]
        for v in C.COST_STAGE_VARS:
            cond = f"{Q.ident(name + '__members')} > 0"
            if v == "ckd_stage_claims":
                cond += " AND ckd_no_esrd_flag = 1"
            rows.append((cond, [
                ("table_id", Q.lit(tid)), ("title", Q.lit(title)), ("fasc_cat", Q.lit(cat)),
                ("med_flag", Q.lit(med)), ("dual_flag", Q.lit(dual)), ("stage_var", Q.lit(v)),
                ("stage", Q.ident(v)), ("cost", Q.ident(f"{name}__{_category_key(cat)}")),
                ("years", Q.ident(f"{name}__years"))]))
    stacked = cuboid.select(Q.unpivot_rows(rows))
    return (stacked.groupBy("table_id", "title", "fasc_cat", "med_flag", "dual_flag",
                            "stage_var", "stage")
                   .agg(F.sum("cost").cast(MONEY_SUM).alias("total_cost"),
                        F.sum("years").cast(YEARS_SUM).alias("n_year"))
                   .select("table_id", "title", "fasc_cat", "med_flag", "dual_flag", "stage_var",
                           "stage", "total_cost", "n_year",
                           _ratio(F.col("total_cost"), F.col("n_year")).alias("cost_per_bene_yr")))
