"""Named tables: replace, commit, resume; the report run on them."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stagewise import DriverFixtures, RunConfig
from stagewise.operators import costs, quality
from stagewise.plans import write_report
from stagewise.sources import NamedTables

CFG = RunConfig(year=1997)


def _root():
    return tempfile.mkdtemp(prefix="stagewise-named-")


def _values(df):
    return sorted(r[0] for r in df.collect())


def test_replace_and_read(spark):
    tables = NamedTables(spark, _root(), "a")
    assert tables.path("t") is None
    with pytest.raises(LookupError):
        tables.read("t")
    tables.replace("t", spark.range(3))
    before = tables.read("t")
    tables.replace("t", spark.range(10, 12))
    assert _values(tables.read("t")) == [10, 11]
    assert _values(before) == [0, 1, 2]  # a reader keeps the version it opened
    # a table may be replaced from itself
    tables.replace("t", tables.read("t").select((F.col("id") + 1).alias("id")))
    assert _values(tables.read("t")) == [11, 12]


def test_a_failed_write_and_a_torn_commit_change_nothing(spark):
    root = _root()
    tables = NamedTables(spark, root, "a")
    tables.replace("t", spark.range(3))
    with pytest.raises(Exception, match="broken"):
        tables.replace("t", spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")))
    assert _values(tables.read("t")) == [0, 1, 2]
    open(f"{root}/t/commits/00000002", "w").close()  # its writer died within it
    assert _values(tables.read("t")) == [0, 1, 2]
    tables.replace("t", spark.range(1))
    assert _values(tables.read("t")) == [0]


def test_two_writers_both_commit(spark):
    root = _root()
    a, b = NamedTables(spark, root, "a"), NamedTables(spark, root, "b")
    a.replace("t", spark.range(1))
    seen = a._commits("t")
    a._commits = lambda name: []  # does not see the number that is taken
    a.replace("t", spark.range(2))
    assert _values(b.read("t")) == [0, 1] and len(b._commits("t")) == len(seen) + 1


def test_empty_table_keeps_its_schema(spark):
    tables = NamedTables(spark, _root(), "a")
    out = tables.replace("t", spark.createDataFrame([], "a int, b array<string>"))
    assert out.schema.simpleString() == "struct<a:int,b:array<string>>" and out.count() == 0
    assert tables.read("t").schema == out.schema


def test_frame_is_built_once_a_run(spark):
    root, built = _root(), []

    def build():
        built.append(1)
        return spark.range(2)

    NamedTables(spark, root, "a").frame("t", build)
    NamedTables(spark, root, "a").frame("t", build)
    assert len(built) == 1
    NamedTables(spark, root, "b").frame("t", build)
    assert len(built) == 2


def test_metrics_are_kept_with_the_commit(spark):
    root, watch = _root(), Observation("seen")
    tables = NamedTables(spark, root, "a")
    tables.frame("t", lambda: spark.range(5).observe(watch, F.count(F.lit(1)).alias("n")).groupBy().agg(F.sum("id").alias("s")), watch)
    assert NamedTables(spark, root, "a").metrics("t") == {"n": 5}


def test_parse_failures_are_counted_in_the_pass(spark):
    day = dt.date(1997, 5, 1)
    rows = [(1, CFG.target_test, "x1", None, day), (2, CFG.target_test, None, ">60+", day), (3, CFG.target_test, "50", None, day),
            (4, "other", "x2", None, day), (5, CFG.target_test, "x3", None, dt.date(1990, 1, 1))]
    labs = spark.createDataFrame(rows, "member_id long, requestcpt string, numericresult string, textresult string, date_servicebegin date")
    watch = Observation("bad")
    quality.watched_labs(labs, CFG, watch).write.format("noop").mode("overwrite").save()
    plain = quality.lab_parse_failures(labs.where((F.col("requestcpt") == CFG.target_test) & (F.year("date_servicebegin") >= 1996))).first()
    assert watch.get == plain.asDict() and watch.get["bad_numeric_text"] == 1


def test_parity_of_the_audit_can_fail(spark):
    day, other = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    schema = "member_id long, from_date date, latest_date date, parsed_date date"
    rows = [(1, day, day, day), (2, None, None, None)]
    assert tuple(quality.dx_parity_of(spark.createDataFrame(rows, schema)).first()) == (1, 1, True)
    for bad in ((3, None, None, day), (3, day, other, day), (3, day, day, None)):
        assert not quality.dx_parity_of(spark.createDataFrame([*rows, bad], schema)).first()["parity"]
    with pytest.raises(AssertionError):
        quality.assert_parity(quality.dx_parity_of(spark.createDataFrame([(3, None, None, day)], schema)))
    assert quality.dx_parity_of(spark.createDataFrame([], schema)).first()["parity"]


def test_parity_reads_the_diagnoses_once(spark):
    from stagewise import StagingRun
    run = StagingRun(DriverFixtures(spark, SF_SMALL), CFG)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(run.dx_parity).count("Relation") == plan(run.dx_bag).count("Relation")


def test_a_killed_report_resumes_behind_its_last_frame(spark, monkeypatch):
    root, day = _root(), dt.date(2020, 1, 2)
    args = dict(run_date=day, resume="nightly", spark=spark)
    inputs = DriverFixtures(spark, SF_SMALL)

    def killed(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(costs, "cost_battery", killed)
        with pytest.raises(RuntimeError, match="killed"):
            write_report(inputs, CFG, root, **args)
    base = f"{root}/year={CFG.year}/run_date=2020-01-02/tables"
    done = {n: os.listdir(f"{base}/{n}") for n in ("lab_summary", "dx_audit", "final_flags", "report_cuboid")}

    class NoLabs(DriverFixtures):
        def table(self, name, year=None):
            if name in ("dx_long", "condition_flags"):
                raise AssertionError(f"{name} is read again")
            return super().table(name, year)

    paths = write_report(NoLabs(spark, SF_SMALL), CFG, root, **args)
    assert {n: os.listdir(f"{base}/{n}") for n in done} == done  # not written again
    plain = write_report(inputs, CFG, _root(), run_date=day, spark=spark)
    assert set(paths) == set(plain)
    rows = lambda p: sorted(map(tuple, spark.read.parquet(p).collect()), key=str)
    for name in paths:
        assert rows(paths[name]) == rows(plain[name]), name
    # another run of the same folder computes anew
    again = write_report(inputs, CFG, root, **{**args, "resume": "other"})
    assert again["cost_battery"] != paths["cost_battery"]
