"""Small helpers to write Spark SQL expression text.

Wide unpivots (dozens of literal structs) are cheaper to declare as one SQL
expression than as hundreds of ``Column`` calls: the driver sends one string
and Catalyst parses it, instead of one gateway round trip per literal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(v) -> str:
    """A SQL literal for a Python value (strings quoted, NULL for None)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named_struct(fields: Sequence[tuple[str, str]]) -> str:
    """``named_struct('a', <expr>, ...)`` from (name, sql-expression) pairs."""
    return "named_struct(" + ", ".join(f"{lit(n)}, {e}" for n, e in fields) + ")"


def unpivot_rows(rows: Sequence[tuple[str | None, Sequence[tuple[str, str]]]]) -> Column:
    """Generator column emitting one struct per row whose condition holds.

    ``rows``: (condition SQL or None, [(field, sql-expression), ...]).  Use as
    ``df.select(unpivot_rows(...))``; the fields become columns.
    """
    items = []
    for cond, fields in rows:
        s = named_struct(fields)
        items.append(f"CASE WHEN {cond} THEN {s} END" if cond else s)
    return F.expr(f"inline(filter(array({', '.join(items)}), r -> r IS NOT NULL))")
