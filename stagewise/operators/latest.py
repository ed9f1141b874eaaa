"""Latest-per-key as an aggregation.

"Row with the greatest ordering per key" is written as an aggregate rather than
a self-join to the per-key maximum or a window: the aggregate is partial
(map-side combined), so a key holding a third of all rows is reduced to one
row per map task before the shuffle, and no task ever holds a whole group.

* :func:`latest_by` - generic: ``max(struct(order..., values...))`` for any
  ordering and payload.  A struct buffer makes Spark use a sort-based
  aggregate, so the staging hot paths use the two forms below instead.
* ``max_by(value, order)`` - when the ordering is unique per key (e.g. rows
  already grouped per (key, day)); plain buffers, hash aggregate.
* :func:`date_code_key` - "latest date, greatest small integer code that day"
  as the ``max`` of one order-preserving BIGINT; hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_struct(order: Sequence[str | Column], values: Sequence[str | Column] = (),
                  where: Column | None = None) -> Column:
    """``max(struct(order..., values...))``; rows failing ``where`` are ignored."""
    s = F.struct(*order, *values)
    if where is not None:
        s = F.when(where, s)
    return F.max(s)


def latest_by(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
              values: Sequence[str] = ()) -> DataFrame:
    """Per ``key``, the (order, values) of the greatest ``order`` tuple.

    Ties on ``order`` are broken by the greatest ``values`` tuple.  Rows with a
    NULL key or a NULL first ordering column are dropped first, as an equi-join
    to the per-key maximum would drop them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cond = F.col(order[0]).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    agg = (df.where(cond).groupBy(*keys)
             .agg(latest_struct(order, values).alias("_latest")))
    return agg.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in [*order, *values]])


# -- hash-aggregatable form for (date, small integer code) ---------------------

CODE_WIDTH = 100_000


def date_code_key(d: Column, code: Column, width: int = CODE_WIDTH) -> Column:
    """Order-preserving BIGINT for (date, code), 0 <= code < width - 1.

    ``max`` of the key is the latest date and, on that date, the greatest code
    (a NULL code sorts lowest, as in struct ordering).  Unlike ``max(struct)``,
    whose struct buffer forces a sort-based aggregate, a BIGINT ``max`` runs as
    a hash aggregate with map-side combine.  NULL dates give a NULL key.  A code
    outside the range fails the job: its key would read back as another day.
    """
    fits = code.isNull() | ((code >= 0) & (code < width - 1))
    code = F.when(fits, code).otherwise(F.raise_error(F.concat(F.lit("code out of range: "), code.cast("string"))).cast("bigint"))
    slot = F.coalesce(code.cast("bigint") + F.lit(1), F.lit(0))
    return F.unix_date(d).cast("bigint") * F.lit(width) + slot


def key_date(k: Column, width: int = CODE_WIDTH) -> Column:
    return F.date_from_unix_date(((k - F.pmod(k, F.lit(width))) / F.lit(width)).cast("int"))


def key_code(k: Column, width: int = CODE_WIDTH) -> Column:
    slot = F.pmod(k, F.lit(width))
    return F.when(slot > 0, slot - F.lit(1))
