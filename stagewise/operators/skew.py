"""Joins and group totals on raw rows whose keys may be NULL or hot.

A row that a join cannot match, or is answered otherwise, must not follow its key to
one task.  ``apart`` gives it a second join key of its own: the other side's is
always zero, and rows set apart have another value that depends on the row and
its partition, so that they spread over all tasks and a re-run task deals them
out as before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 1 << 20
#: a key is hot from this many rows on if it also holds more than one in HOT_SHARE of all; so at most HOT_SHARE keys are
HOT_ROWS, HOT_SHARE = 1000, 256
DEALT_ROWS = 500_000


def never_apart(*keys: str) -> Column:
    """Zero, as an expression of ``keys`` that stays a join key (a literal would be folded away)."""
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def apart(condition: Column, *columns: str) -> Column:
    """Zero; for rows with ``condition`` a number above it, by the row's ``columns`` and partition."""
    own = F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(SPREAD)) + 1
    return F.when(condition, own).otherwise(never_apart(*columns))


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` spread evenly over tasks of about ``DEALT_ROWS``, whatever their keys and however the table is split.

    For rows that a partial aggregate can hardly reduce: a task that reads one split of a
    small or well compressed file would hold as many groups as the split has rows.  The
    rows are counted when the query runs; at most ``spark.sql.shuffle.partitions`` tasks get some.
    """
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(rows.agg(F.count(F.lit(1))).scalar() / DEALT_ROWS)))
    own = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), tasks).cast("int")
    return rows.withColumn("_deal", own).repartitionById(most, "_deal").drop("_deal")


def lookup(rows: DataFrame, table: DataFrame, key: str, other: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` left joined to ``columns`` of ``table`` on ``key`` = ``other``, in one pass: rows with
    a NULL key match nothing and are dealt out over all tasks.  Rows that match several of ``table`` repeat."""
    left = rows.withColumn("_apart", apart(F.col(key).isNull(), *rows.columns))
    right = table.select(F.col(other).alias("_other"), *columns, never_apart(other).alias("_never"))
    return (left.join(right, (F.col(key) == F.col("_other")) & (F.col("_apart") == F.col("_never")), "left")
                .select(*rows.columns, *columns))


def with_totals(rows: DataFrame, keys: Sequence[str], totals: Sequence[Column]) -> DataFrame:
    """Every row of ``rows`` with its group's ``totals`` (aliased aggregates), as window aggregates over
    ``keys`` would give them; NULL is a group.

    No group is gathered: totals are partial aggregates, those of hot keys (at most
    ``HOT_SHARE``) are broadcast and their rows set apart, the others' meet by a
    shuffle join.
    """
    keys = list(keys)
    groups = rows.groupBy(*keys).agg(*totals, F.count(F.lit(1)).alias("_rows"))
    names = [c for c in groups.columns if c not in (*keys, "_rows")]
    everything = groups.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    hot = (F.col("_rows") >= HOT_ROWS) & (F.col("_rows") * HOT_SHARE > everything)
    named = lambda df, tag: df.select(*[F.col(k).alias(f"_{tag}_{k}") for k in keys], *[F.col(c).alias(f"_{tag}_{c}") for c in names], F.lit(True).alias(f"_{tag}"))
    few, many = named(groups.where(hot), "hot"), named(groups.where(~hot), "cold")

    def same(tag: str) -> Column:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_{tag}_{k}"))
        return on
    marked = rows.join(F.broadcast(few), same("hot"), "left")
    marked = marked.withColumn("_apart", apart(F.col("_hot").isNotNull(), *rows.columns))
    many = many.withColumn("_never", never_apart(*[f"_cold_{k}" for k in keys]))
    met = marked.join(many, same("cold") & (F.col("_apart") == F.col("_never")), "left")
    return met.select(*rows.columns, *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in names])


def rows_on_latest_day(rows: DataFrame, key: str, day: str, dated_by: Column | None = None) -> DataFrame:
    """All rows of each ``key`` on its latest ``day``, ties and whole payload kept.

    ``dated_by`` limits the rows that decide which day is the latest (not the
    rows returned).  Rows without key or day belong to no day.
    """
    dated = rows.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    of = F.col(day) if dated_by is None else F.when(dated_by, F.col(day))
    return with_totals(dated, [key], [F.max(of).alias("_latest_day")]).where(F.col(day) == F.col("_latest_day")).drop("_latest_day")


def side_by_side(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join on ``on`` in which NULL equals NULL: ``on``, then the other columns of both sides.

    A key missing on one side has NULLs there.  Meant for grouped frames, where a
    key is one row; repeated keys give their product.
    """
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    both = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns], F.lit(True).alias("_r"))
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = left.join(both, same, "full_outer")
    keys = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) for c in on]
    return joined.select(*keys, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on])
