"""Diagnosis claims: parse, latest-day stage, refinement of unspecified stage 3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CKD_DX_CODES, DX_SPECIFIC_3, DX_UNSPECIFIED_3
from ..functions.parsing import dx_number
from .latest import date_code_key, key_code, key_date
from .skew import lookup


def parse_dx(dx_current: DataFrame, dx_previous: DataFrame, headers: DataFrame,
             distinct: bool = True) -> DataFrame:
    """Two years of diagnosis rows, kept to the CKD codes, with the claim's
    service date attached and the code turned into a 4-digit number.

    ``distinct=True`` de-duplicates whole rows like a SQL ``UNION``.  Everything
    downstream takes maxima, which duplicates cannot change, so the staging path
    passes ``distinct=False`` and saves the full-row shuffle.  The code filter
    is pushed below the union to both scans by Catalyst.

    Whole rows means every column of the tables, declared or not: rows that
    differ in one of them stay apart, and all come out.  A column that only one
    year has is NULL in the other.  Each table is read once; rows without a claim
    id match no header.
    """
    clash = {"from_date", "dx_num"} & {c.lower() for c in [*dx_current.columns, *dx_previous.columns]}
    if clash:
        raise ValueError(f"diagnosis tables have columns that the parsed rows add: {sorted(clash)}")
    both = dx_current.unionByName(dx_previous, allowMissingColumns=True)
    if distinct:
        both = both.distinct()
    dx = both.where(F.col("dx_code").isin(*CKD_DX_CODES))
    return lookup(dx, headers, "claim_id", "claim_id", ["from_date"]).withColumn("dx_num", dx_number(F.col("dx_code")))


def latest_dx(dx: DataFrame) -> DataFrame:
    """Per member, the latest service date and the highest number that day."""
    return (refine_all(dx).select("member_id", F.col("latest_date").alias("from_date"),
                                  F.col("latest_num").alias("dx_num")))


def refine_all(dx: DataFrame, audit: bool = False) -> DataFrame:
    """One aggregation per member giving the latest diagnosis and, when that is
    unspecified stage 3, the most recent specific stage 3 (value *and* date).

    "Latest date, greatest number that day" is the maximum of an
    order-preserving (date, number) key, so both selections are plain BIGINT
    maxima of one hash aggregate (map-side combined; a hot member never lands
    whole in one task).  Rows without member or date are dropped first, as an
    equi-join to the per-member maximum date would drop them.

    Output: member_id, dx_num, from_date, unspecified (latest was unspecified 3),
    refined (a specific stage 3 replaced it), latest_num, latest_date (before
    refinement).  ``audit`` adds parsed_date, the plain maximum of the parsed
    dates, and a row with NULLs for each member without a dated diagnosis, for
    the parity check.
    """
    key_ok = F.col("member_id").isNotNull()
    if not audit:
        key_ok = key_ok & F.col("from_date").isNotNull()
    k = date_code_key(F.col("from_date"), F.col("dx_num"))
    agg = (dx.where(key_ok).groupBy("member_id")
             .agg(F.max(k).alias("_l"),
                  F.max(F.when(F.col("dx_num").isin(*DX_SPECIFIC_3), k)).alias("_s"),
                  *([F.max("from_date").alias("parsed_date")] if audit else [])))
    num_type = "decimal(38,0)"
    l_num, l_date = key_code(F.col("_l")).cast(num_type), key_date(F.col("_l"))
    s_num, s_date = key_code(F.col("_s")).cast(num_type), key_date(F.col("_s"))
    unspec = l_num == DX_UNSPECIFIED_3
    use_spec = unspec & F.col("_s").isNotNull()
    return agg.select(
        "member_id",
        F.when(use_spec, s_num).otherwise(l_num).alias("dx_num"),
        F.when(use_spec, s_date).otherwise(l_date).alias("from_date"),
        unspec.alias("unspecified"),
        use_spec.alias("refined"),
        l_num.alias("latest_num"),
        l_date.alias("latest_date"),
        *(["parsed_date"] if audit else []))


def refine_unspecified(dx: DataFrame) -> DataFrame:
    """Members whose latest diagnosis is unspecified stage 3, after refinement."""
    return refine_all(dx).where("unspecified").select("member_id", "dx_num", "from_date")


def dx_stage_final(dx: DataFrame) -> DataFrame:
    """One claim-based stage per member: refined unspecified-3 plus all others."""
    return refine_all(dx).select("member_id", "dx_num", "from_date")
