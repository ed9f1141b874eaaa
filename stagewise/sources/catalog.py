"""Resolve logical inputs ``(name, year) -> DataFrame``.

Three layouts are supported:

* :class:`TableInputs` - one parquet dataset per logical table, partitioned by
  ``year`` for the year-specific ones (``<root>/<name>/year=1997/...``; a year
  is a partition filter, so Spark prunes the other years at planning time), or
  one folder per year (``<root>/<name>_1997/``).
* :class:`CatalogInputs` - catalog tables by name pattern, e.g.
  ``{"enroll": "common.enroll_{year}", "labs": "lab.results"}``: fixed-name
  tables and year-suffixed table families, read with ``spark.table``.
* :class:`FrameInputs` - any mapping of already-built frames, e.g. the fixture
  derivation in :mod:`stagewise.sources.fixtures` or a test's inline tables.

Every frame is projected and cast to its declared schema on the way out, so
operators can rely on column names and types.  Keys stay as they are: a text
``member_id`` such as ``A12`` is as good as a number.  Where sources disagree
about a key's type, ``keys={"member_id": "string"}`` casts it in all tables.
Tables whose whole rows count also keep their undeclared columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import KEYS, LOGICAL, WHOLE_ROWS


def conform(df: DataFrame, name: str, keys: Mapping[str, str] | None = None) -> DataFrame:
    """Project ``df`` onto the declared schema of ``name`` (missing column = error); ``keys``: type by key."""
    schema, _ = LOGICAL[name]

    def one(field) -> str:
        kind = (keys or {}).get(field.name) if field.name in KEYS else field.dataType.simpleString()
        return f"CAST(`{field.name}` AS {kind}) AS `{field.name}`" if kind else f"`{field.name}` AS `{field.name}`"
    # resolved lazily (case-insensitively) at analysis; a missing column fails there
    declared = {f.name.lower() for f in schema.fields}
    more = [f"`{c.replace('`', '``')}`" for c in df.columns if c.lower() not in declared] if name in WHOLE_ROWS else []
    return df.selectExpr(*[one(f) for f in schema.fields], *more)


class Inputs:
    """Base resolver; subclasses implement :meth:`_load`.  ``keys``: types to cast keys to, by name."""

    keys: Mapping[str, str] | None = None

    def table(self, name: str, year: int | None = None) -> DataFrame:
        if name not in LOGICAL:
            raise KeyError(f"unknown logical table {name!r}")
        _, per_year = LOGICAL[name]
        if per_year and year is None:
            raise ValueError(f"{name} is year-specific; pass year")
        return conform(self._load(name, year if per_year else None), name, self.keys)

    def _load(self, name: str, year: int | None) -> DataFrame:  # pragma: no cover
        raise NotImplementedError


class TableInputs(Inputs):
    """Datasets under ``root``, one folder per logical table.

    ``layout="partitioned"``: year-specific tables are one dataset partitioned
    by ``year`` (``<root>/enroll/year=1997/``), so a year is a partition filter.
    ``layout="suffixed"``: one folder per year (``<root>/enroll_1997/``).
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet",
                 layout: str = "partitioned", keys: Mapping[str, str] | None = None):
        if layout not in ("partitioned", "suffixed"):
            raise ValueError(f"unknown layout {layout!r}")
        self.spark, self.root, self.fmt, self.layout, self.keys = spark, root.rstrip("/"), fmt, layout, keys

    def _load(self, name, year):
        reader = self.spark.read.format(self.fmt)
        if year is not None and self.layout == "suffixed":
            return reader.load(f"{self.root}/{name}_{year}")
        df = reader.load(f"{self.root}/{name}")
        if year is not None:
            df = df.where(F.col("year") == F.lit(year)).drop("year")  # the layout's column, not the table's
        return df


class FrameInputs(Inputs):
    """Frames supplied by the caller: ``{name: df}`` or ``{name: {year: df}}``,
    or a callable ``(name, year) -> df``."""

    def __init__(self, frames: Mapping | Callable[[str, int | None], DataFrame], keys: Mapping[str, str] | None = None):
        self.frames, self.keys = frames, keys

    def _load(self, name, year):
        if callable(self.frames):
            return self.frames(name, year)
        entry = self.frames[name]
        if isinstance(entry, Mapping):
            return entry[year]
        return entry


class CatalogInputs(Inputs):
    """Catalog tables by name pattern; ``{year}`` in a pattern selects the
    year-suffixed member of a table family (``enroll_{year}``)."""

    def __init__(self, spark: SparkSession, names: Mapping[str, str], keys: Mapping[str, str] | None = None):
        self.spark, self.names, self.keys = spark, dict(names), keys

    def _load(self, name, year):
        pattern = self.names[name]
        if year is None and "{year}" in pattern:
            raise ValueError(f"{name}: pattern {pattern!r} needs a year")
        return self.spark.table(pattern.format(year=year))
