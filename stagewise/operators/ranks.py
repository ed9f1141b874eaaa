"""Exact percentiles by distributed rank selection.

A group's values are never gathered.  They are counted by value (map-side
combined, so a value holding a third of all rows is one row per task), and the
ranks that the percentiles need are looked for in three steps, each an aggregate
and a running total over a bounded number of rows:

1. a histogram on a fixed scale that every double has a place on (``COARSE``
   steps per unit of log(1 + |x|), at most some 90,000 bins a group);
2. the bins that hold a wanted rank, cut evenly into ``FINE`` bins each between
   their own smallest and largest value;
3. the values of the fine bins that hold a wanted rank, in order.

A bin with one distinct value needs no further step.  Every step's bins depend on
the values alone, so a recomputed partition gives the same ones; the two
neighbours of each percentile are then picked and interpolated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

COARSE, FINE = 64, 65_536
#: bins beyond all finite doubles
_INFINITE, _NAN = 1 << 40, 1 << 41


def coarse_bin(x: Column) -> Column:
    """A bin that never falls as ``x`` (double) grows; NaN is above all."""
    size = F.floor(F.log1p(F.abs(x)) * COARSE)
    finite = F.when(x < 0, -size).otherwise(size).cast("bigint")
    return (F.when(F.isnan(x), F.lit(_NAN)).when(x == float("inf"), F.lit(_INFINITE))
             .when(x == float("-inf"), F.lit(-_INFINITE)).otherwise(finite).cast("bigint"))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[f"_r_{k}"])
    return on


def _attach(rows: DataFrame, picked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` of the bins in ``picked``, with their wanted ranks; NULL keys meet."""
    picked = picked.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_wanted", "_lo", "_hi")
    return rows.join(picked, _same(rows, picked, keys), "inner").drop(*[f"_r_{k}" for k in keys])


def _hits(wanted: Column, before: Column, n: Column) -> Column:
    """The wanted (target, rank) that fall on the ``n`` places after ``before``, counted from there."""
    inside = F.filter(wanted, lambda w: (w["rank"] >= before) & (w["rank"] < before + n))
    return F.transform(inside, lambda w: F.struct(w["target"].alias("target"), (w["rank"] - before).alias("rank")))


def _step(binned: DataFrame, keys: Sequence[str], bin_name: str) -> DataFrame:
    """(keys, bin, _wanted, _lo, _hi) of the bins that hold a wanted rank; ``binned`` has a row for each
    bin: _n, _lo, _hi and the enclosing bin's _wanted."""
    upto = Window.partitionBy(*keys).orderBy(bin_name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_n").over(upto) - F.col("_n")
    held = binned.withColumn("_before", before).withColumn("_wanted", _hits(F.col("_wanted"), F.col("_before"), F.col("_n")))
    return held.where(F.size("_wanted") > 0).select(*keys, bin_name, "_wanted", "_lo", "_hi")


def ranked_values(df: DataFrame, value: str, by: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(by..., _n, _sum, _min, _max, _at): of each group the number of values, their sum, extremes, and the
    values at the lower and upper neighbour of each probability, in order (2 for each)."""
    by = list(by)
    kind = df.schema[value].dataType
    floating = isinstance(kind, (T.DoubleType, T.FloatType))
    counted = (df.select(*by, F.col(value).alias("_v")).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
                 .withColumn("_x", F.col("_v").cast("double")))
    # exact where the values are
    worth = (F.col("_x") * F.col("_n") if floating
             else F.col("_v").cast(kind if isinstance(kind, T.DecimalType) else "decimal(19,0)") * F.col("_n").cast("decimal(18,0)"))
    present = F.col("_v").isNotNull()
    stats = counted.groupBy(*by).agg(F.coalesce(F.sum(F.when(present, F.col("_n"))), F.lit(0)).alias("_n"),
                                     F.sum(worth).cast("double").alias("_sum"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    values = counted.where(present).withColumn("_b1", coarse_bin(F.col("_x")))

    # the whole group's places are wanted in the coarse histogram
    total = F.sum("_n").over(Window.partitionBy(*by))
    places = F.array(*[F.struct(F.lit(2 * i + up).alias("target"), (F.ceil(p * (total - 1)) if up else F.floor(p * (total - 1))).cast("bigint").alias("rank"))
                       for i, p in enumerate(probabilities) for up in (0, 1)])
    bins = lambda rows, keys: rows.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    coarse = _step(bins(values, [*by, "_b1"]).withColumn("_wanted", places), by, "_b1")

    one = F.col("_lo").eqNullSafe(F.col("_hi"))
    done = lambda picked: picked.where(one).select(*by, F.col("_lo").alias("_x"), "_wanted")
    key1, key2 = [*by, "_b1"], [*by, "_b1", "_b2"]
    spread = _attach(values, coarse.where(~one), key1)
    share = (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    spread = spread.withColumn("_b2", F.floor(share * FINE).cast("bigint"))
    inner = spread.groupBy(*key2).agg(F.sum("_n").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.any_value("_wanted").alias("_wanted"))
    fine = _step(inner, key1, "_b2")
    last = _attach(spread.drop("_wanted", "_lo", "_hi"), fine.where(~one), key2)
    last = last.select(*key2, "_x", "_n", "_wanted", F.col("_x").alias("_lo"), F.col("_x").alias("_hi"))
    exact = _step(last, key2, "_x")

    found = done(coarse).unionByName(done(fine)).unionByName(exact.select(*by, "_x", "_wanted"))
    hits = found.select(*by, "_x", F.explode("_wanted.target").alias("_target"))
    at = hits.groupBy(*by).agg(F.array(*[F.max(F.when(F.col("_target") == t, F.col("_x"))) for t in range(2 * len(probabilities))]).alias("_at"))
    if not by:  # one row each
        return stats.select("*", at.scalar().alias("_at"))
    at = at.select(*[F.col(k).alias(f"_r_{k}") for k in by], "_at")
    return stats.join(at, _same(stats, at, by), "left").select(*stats.columns, "_at")


def percentile_of(i: int, p: float) -> Column:
    """The interpolated percentile from its neighbours in ``_at``."""
    place = F.lit(p) * (F.col("_n") - 1)
    low, high = F.col("_at")[2 * i], F.col("_at")[2 * i + 1]
    return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)
