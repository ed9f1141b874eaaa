"""The report as one titled text, written by tasks.

Every table is a title, a heading, its rows and an empty line, in report order.
Rows of all tables become lines that carry their place (section, table, part of
the table, row order); one range-partitioned sort puts them in order, and each
task writes its range, so the part files in name order are the report.  Only a
table's layout (widths and which columns are numbers, a row a table) is gathered
and broadcast; its size is bounded by the report's tables and columns, while a
table of free texts may have any number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COST_STAGE_VARS

TITLE, HEADING, ROW, END = range(4)
_PLACE = ["section", "table", "kind", "order"]
_ORDER = "array<struct<missing:boolean,num:double,text:string>>"


def _cell(c: Column) -> Column:
    """A value as one line of text."""
    return F.replace(F.replace(c.cast("string"), F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))


def table_cells(df: DataFrame, section: int, title: Column, heads: Column, values: Column,
                table: Column | None = None, before: Column | None = None) -> DataFrame:
    """(section, table, title, heads, before, cells) of a frame's rows; ``before`` sorts ahead of the cells."""
    return df.select(F.lit(section).alias("section"), (F.lit(1) if table is None else table.cast("int")).alias("table"),
                     title.alias("title"), heads.alias("heads"), (F.lit(0) if before is None else before).cast("int").alias("before"),
                     F.transform(values, _cell).alias("cells"))


def long_cells(df: DataFrame, section: int) -> DataFrame:
    """The tables of a battery: table_id, title, var1, val1, ..., n."""
    width = sum(c.startswith("var") for c in df.columns)
    names = F.filter(F.array(*[F.col(f"var{i + 1}") for i in range(width)]), lambda v: v.isNotNull())
    values = F.slice(F.array(*[F.col(f"val{i + 1}") for i in range(width)]), 1, F.size(names))
    return table_cells(df, section, F.col("title"), F.concat(names, F.array(F.lit("n"))),
                       F.concat(values, F.array(F.col("n").cast("string"))), F.col("table_id"))


def wide_cells(df: DataFrame, section: int, columns: Sequence[str], title: Column, table: Column | None = None,
               before: Column | None = None) -> DataFrame:
    """Tables whose headings are the frame's own columns."""
    return table_cells(df, section, title, F.array(*map(F.lit, columns)),
                       F.array(*[F.col(c).cast("string") for c in columns]), table, before)


def section_cells(name: str, df: DataFrame, section: int) -> DataFrame:
    """A report section's rows as cells of its tables."""
    if {"table_id", "title", "var1", "val1", "n"} <= set(df.columns):
        return long_cells(df, section)
    if "stage_var" in df.columns:  # schemes in the battery's order
        schemes = F.array_position(F.array(*map(F.lit, COST_STAGE_VARS)), F.col("stage_var"))
        columns = ["stage_var", "stage", "total_cost", "n_year", "cost_per_bene_yr"]
        return wide_cells(df, section, columns, F.col("title"), F.col("table_id"), schemes)
    columns = [c for c in df.columns if c != "title"]
    return wide_cells(df, section, columns, F.col("title") if "title" in df.columns else F.lit(name))


def scalar_lines(df: DataFrame, section: int) -> DataFrame:
    """A labelled number (title, n): ``title: n`` and an empty line."""
    lines = [(TITLE, F.concat("title", F.lit(": "), F.col("n").cast("string"))), (END, F.lit(""))]
    return df.select(F.inline(F.array(*[F.struct(F.lit(section).alias("section"), F.lit(1).alias("table"), F.lit(k).alias("kind"),
                                                 F.array().cast(_ORDER).alias("order"), x.alias("line")) for k, x in lines])))


def table_lines(cells: DataFrame) -> DataFrame:
    """(section, table, kind, order, line) of tables: columns right-justified to their widest cell, one space
    between them.  A column whose values are all numbers is ordered as numbers, others as texts; missing
    values come last, as NaN in columns of numbers and None elsewhere."""
    keys = ["section", "table"]
    one = cells.select(*keys, F.posexplode("cells").alias("pos", "cell"))
    number = F.when(F.col("cell").isNotNull(), F.col("cell").try_cast("double").isNotNull())
    size = one.groupBy(*keys, "pos").agg(F.max(F.length("cell")).alias("w"), F.bool_and(number).alias("numeric"),
                                         F.bool_or(F.col("cell").isNull()).alias("gaps"))
    numeric = F.coalesce("numeric", F.lit(False))
    size = size.select(*keys, F.struct("pos", F.greatest(F.coalesce("w", F.lit(0)), F.when(F.col("gaps"), F.when(numeric, 3).otherwise(4)).otherwise(0)).alias("w"),
                                       numeric.alias("numeric")).alias("col"))
    layout = size.groupBy(*keys).agg(F.array_sort(F.collect_list("col")).alias("cols"))
    titles = cells.groupBy(*keys).agg(F.min("title").alias("title"), F.min("heads").alias("heads"))
    layout = layout.join(titles, keys)
    widths = F.zip_with("cols", "heads", lambda c, h: F.greatest(c["w"], F.length(h)))
    layout = layout.select(*keys, "title", "heads", widths.alias("widths"), F.transform("cols", lambda c: c["numeric"]).alias("numeric"))

    def justified(values: Column) -> Column:
        return F.array_join(F.zip_with(values, F.col("widths"), lambda v, w: F.lpad(v, w, F.lit(" "))), " ")

    frame = layout.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.array().cast(_ORDER).alias("order"), x.alias("line"))
                                                    for k, x in ((TITLE, F.col("title")), (HEADING, justified(F.col("heads"))), (END, F.lit("")))])))
    rows = cells.drop("title", "heads").join(F.broadcast(layout), keys)  # a row a table
    shown = F.zip_with("cells", "numeric", lambda v, n: F.coalesce(v, F.when(n, F.lit("NaN")).otherwise(F.lit("None"))))
    lead = F.array(F.struct(F.lit(False).alias("missing"), F.col("before").cast("double").alias("num"), F.lit("").alias("text")))
    order = F.zip_with("cells", "numeric", lambda v, n: F.struct(
        v.isNull().alias("missing"), F.coalesce(F.when(n, v.try_cast("double")), F.lit(0.0)).alias("num"), F.coalesce(v, F.lit("")).alias("text")))
    rows = rows.select(*keys, F.lit(ROW).alias("kind"), F.concat(lead, order).cast(_ORDER).alias("order"), justified(shown).alias("line"))
    return frame.unionByName(rows)


def report_lines(sections: Mapping[str, DataFrame]) -> DataFrame:
    """(section, table, kind, order, line) of all sections, in no order yet."""
    out = None
    for i, (name, df) in enumerate(sections.items()):
        lines = scalar_lines(df, i) if df.columns == ["title", "n"] else table_lines(section_cells(name, df, i))
        out = lines if out is None else out.unionByName(lines)
    return out


def write_text(sections: Mapping[str, DataFrame], path: str) -> str:
    """Write the sections, in their order, as one titled text: the part files of ``path`` in name order."""
    report_lines(sections).orderBy(*_PLACE).select("line").write.mode("overwrite").text(path)
    return path
