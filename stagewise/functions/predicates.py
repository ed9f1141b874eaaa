"""Predicates built from run parameters (never from interpolated SQL text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ADULT_AGE, CAT_DRUG


def flag_where(c: Column, value: str) -> Column:
    """``both`` -> flag in (Y, N) (NULL still dropped); else flag = value."""
    if value == "both":
        return c.isin("Y", "N")
    return c == F.lit(value)


def category_where(c: Column, category: str) -> Column:
    """``all`` -> any category but drug; else that category (case-folded)."""
    if category == "all":
        return F.lower(c) != F.lit(CAT_DRUG)
    return F.lower(c) == F.lit(category.lower())


def adults(age: Column) -> Column:
    return age >= ADULT_AGE


def apply_where(df: DataFrame, where: Column | str | None) -> DataFrame:
    """Optional filter: ``None``/``""`` means no filter."""
    if where is None or (isinstance(where, str) and not where.strip()):
        return df
    return df.where(where if isinstance(where, Column) else F.expr(where))
