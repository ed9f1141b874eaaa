"""The titled text report against one put together from collected rows."""

import datetime as dt
import glob
import tempfile

from conftest import SF_SMALL
from stagewise import DriverFixtures, RunConfig
from stagewise.config import COST_STAGE_VARS
from stagewise.operators.costs import battery_titles
from stagewise.operators.frequency import crosstab_tables, stage_frequency_tables
from stagewise.plans import write_report, write_text

CFG = RunConfig(year=1997)


def _text(path):
    """The part files in name order."""
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))


def _table(title, heads, rows):
    """A title, the columns right-justified, an empty line."""
    numeric = []
    for i in range(len(heads)):
        try:
            known = [float(r[i]) for r in rows if r[i] is not None]
            numeric.append(bool(known))
        except ValueError:
            numeric.append(False)
    key = lambda r: [(c is None, float(c) if n and c is not None else 0.0, "" if c is None else c) for c, n in zip(r, numeric)]
    rows = [[c if c is not None else "NaN" if n else "None" for c, n in zip(r, numeric)] for r in sorted(rows, key=key)]
    width = [max(len(x) for x in col) for col in zip(heads, *rows)]
    return "\n".join([title] + [" ".join(c.rjust(w) for c, w in zip(r, width)) for r in (heads, *rows)]) + "\n\n"


def _write(sections):
    return _text(write_text(sections, tempfile.mkdtemp(prefix="stagewise-text-") + "/text"))


def test_the_report_text(spark):
    paths = write_report(DriverFixtures(spark, SF_SMALL), CFG, tempfile.mkdtemp(prefix="stagewise-text-"), run_date=dt.date(2020, 1, 2),
                         text=True, spark=spark)
    rows = {n: spark.read.parquet(p).collect() for n, p in paths.items() if n != "text"}
    flag = rows["flag_minus_esrd_count"][0]
    expected = f"{flag['title']}: {flag['n']}\n\n"
    for section, tables in (("stage_frequencies", stage_frequency_tables(CFG)), ("crosstab_battery", crosstab_tables(CFG, "a", "b"))):
        for t in tables:
            mine = [[r[f"val{i + 1}"] for i in range(len(t.dims))] + [str(r["n"])] for r in rows[section] if r["table_id"] == t.table_id]
            if mine:
                expected += _table(t.title, [*t.dims, "n"], mine)
    heads = ["month", "ckd_stage_claims_date", "ckd_jvhl_claims_date"]
    expected += _table(f"Monthly counts of claims and labs in {CFG.year}", heads,
                       [[None if r[h] is None else str(r[h]) for h in heads] for r in rows["monthly_counts"]])
    heads = ["stage_var", "stage", "total_cost", "n_year", "cost_per_bene_yr"]
    text = _text(paths["text"])
    assert text.startswith(expected)
    # the cost tables: titles in order, schemes in order within each
    at = len(expected)
    for i, title in enumerate(battery_titles(CFG), start=1):
        mine = [r for r in rows["cost_battery"] if r["table_id"] == i]
        if not mine:
            continue
        assert text.startswith(title + "\n", at)
        block = text[at:text.index("\n\n", at)].split("\n")
        assert block[1].split() == heads and len(block) == len(mine) + 2
        schemes = [line.split()[0] for line in block[2:]]
        assert schemes == sorted(schemes, key=COST_STAGE_VARS.index)
        at += len("\n".join(block)) + 2
    assert at == len(text)


def test_free_text_tables_over_many_tasks(spark):
    n = 3000
    df = spark.range(n).selectExpr("1 AS table_id", "'free' AS title", "'v' AS var1", "concat('t', id % 2999) AS val1", "CAST(NULL AS STRING) AS var2",
                                   "CAST(NULL AS STRING) AS val2", "id AS n").repartition(7)
    odd = spark.createDataFrame([("10", 1), ("9", 2), (None, 3)], "a string, n long")
    texts = spark.createDataFrame([("x\ny", 1), ("10", 2), ("9", 3), (None, 4)], "a string, k long")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the parts stay apart
    try:
        path = write_text({"free": df, "numbers": odd, "mixed": texts}, tempfile.mkdtemp(prefix="stagewise-text-") + "/text")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len([p for p in glob.glob(f"{path}/part-*") if open(p).read()]) > 1
    expected = _table("free", ["v", "n"], [[f"t{i % 2999}", str(i)] for i in range(n)])
    expected += "numbers\n  a n\n  9 2\n 10 1\nNaN 3\n\n"
    expected += "mixed\n   a k\n  10 2\n   9 3\nx\\ny 1\nNone 4\n\n"
    assert _text(path) == expected


def test_empty_frames_have_no_lines(spark):
    df = spark.createDataFrame([], "table_id int, title string, var1 string, val1 string, n long")
    assert _write({"none": df}) == ""
