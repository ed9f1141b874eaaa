"""Inline value lists as small tables (the caller's literal rows, e.g. a code list)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def values_table(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str],
                 view: str | None = None, schema: str | None = None) -> DataFrame:
    """Build a table from literal rows with named columns; optionally register a view.

    Meant for short code lists; its size is the caller's literal, so joining it
    with ``F.broadcast`` is always safe.
    """
    if schema is None:
        df = spark.createDataFrame([tuple(r) for r in rows], list(columns))
    else:
        df = spark.createDataFrame([tuple(r) for r in rows], schema)
    if view:
        df.createOrReplaceTempView(view)
    return df
