"""Whole-run surfaces: partitioned table layout, report writer,
and the physical shape of the skew-sensitive plans."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stagewise import DriverFixtures, FrameInputs, RunConfig, StagingRun, TableInputs
from stagewise.operators import frequency
from stagewise.plans import render_text, write_report
from stagewise.sources import LOGICAL

from conftest import SF_SMALL

CFG = RunConfig()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def warehouse(spark):
    """The fixtures written once as a year-partitioned parquet warehouse."""
    root = tempfile.mkdtemp(prefix="stagewise-wh-")
    fx = DriverFixtures(spark, SF_SMALL)
    for name, (_, per_year) in LOGICAL.items():
        if per_year:
            years = [CFG.year, CFG.prev_year]
            df = None
            for y in years:
                part = fx.table(name, y).withColumn("year", F.lit(y))
                df = part if df is None else df.unionByName(part)
            df.write.partitionBy("year").parquet(f"{root}/{name}")
        else:
            fx.table(name).write.parquet(f"{root}/{name}")
    return root


def test_table_inputs_match_fixtures(spark, warehouse):
    a = StagingRun(TableInputs(spark, warehouse), CFG).final_flags
    b = StagingRun(DriverFixtures(spark, SF_SMALL), CFG).final_flags
    assert _rows(a) == _rows(b)


def test_year_is_a_partition_filter(spark, warehouse):
    df = TableInputs(spark, warehouse).table("enroll", CFG.year)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1][:200]


def test_missing_column_fails_fast(spark):
    bad = FrameInputs({"member": {1997: spark.createDataFrame([(1,)], "member_id long")}})
    with pytest.raises(Exception):
        bad.table("member", 1997).columns


def test_write_report_layout_and_text(spark):
    root = tempfile.mkdtemp(prefix="stagewise-report-")
    paths = write_report(DriverFixtures(spark, SF_SMALL), CFG, root, run_date=dt.date(2020, 1, 2))
    assert set(paths) >= {"stage_frequencies", "crosstab_battery", "monthly_counts", "cost_battery",
                          "qa_frequencies", "flag_minus_esrd_count", "qa_both_sources_sample", "data_quality"}
    for name, p in paths.items():
        assert p.startswith(f"{root}/year={CFG.year}/run_date=2020-01-02/")
        assert os.path.isdir(p)
    freq = spark.read.parquet(paths["stage_frequencies"])
    assert freq.count() > 0
    # the report (shared cuboid, checkpointed inputs) equals the standalone queries
    from stagewise.operators import frequency as Q
    run = StagingRun(DriverFixtures(spark, SF_SMALL), CFG)
    expected = {
        "stage_frequencies": Q.stage_frequencies(run.final_flags, CFG),
        "crosstab_battery": Q.crosstab_battery(run.final_flags, CFG),
        "qa_frequencies": Q.qa_frequencies(run.labs_normalised, run.latest_lab, run.final_flags, CFG),
        "monthly_counts": Q.monthly_counts(run.final_flags),
        "cost_battery": run.cost_battery,
    }
    for name, df in expected.items():
        assert _rows(spark.read.parquet(paths[name]).select(*df.columns)) == _rows(df), name
    text = render_text({"stage_frequencies": freq.orderBy("table_id", "val1")})
    assert text.startswith("stage_frequencies\n") and "ckd_stage_comb_all" in text


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_member_is_pre_aggregated(spark):
    """One member with a third of all lab rows: same answer as the naive form,
    and every member-keyed exchange sits on top of a partial aggregate."""
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        m = 1 if hot else 2 + i % 97
        d = dt.date(1997, 1, 1) + dt.timedelta(days=i % 200)
        rows.append((m, "33914-3", str(30 + i % 50), None, d))
    labs = spark.createDataFrame(rows, "member_id long, requestcpt string, numericresult string, "
                                       "textresult string, date_servicebegin date")
    from stagewise.operators import labs as L
    jv = L.normalise_labs(labs, CFG)
    latest = L.latest_lab(jv, CFG)
    got = {r["member_id"]: (r["date_servicebegin"], r["all_results"], r["n_labs"]) for r in latest.collect()}
    tgt = jv.where("all_results is not null")
    mx = {r[0]: r[1] for r in tgt.groupBy("member_id").agg(F.max("date_servicebegin")).collect()}
    for m, d in mx.items():
        day = tgt.where((F.col("member_id") == m) & (F.col("date_servicebegin") == d))
        vals = [r[0] for r in day.select("all_results").collect()]
        assert got[m] == (d, min(vals), len(set(vals)))
    plan = _plan(latest)
    for line_no, line in enumerate(plan.splitlines()):
        if "Exchange hashpartitioning(member_id" in line:
            below = plan.splitlines()[line_no + 1]
            assert "HashAggregate" in below and "partial_" in below, below


def test_staging_plan_has_no_window_cross_or_nested_loop(spark):
    run = StagingRun(DriverFixtures(spark, SF_SMALL), CFG)
    for df in (run.final_flags, run.cost_battery, run.claim_prep):
        plan = _plan(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window ", "collect_list", "collect_set",
                    "SortAggregate"):
            assert bad not in plan, bad


def test_filters_reach_the_parquet_scans(spark, warehouse):
    """On a real warehouse layout the year window and test code reach the lab
    scan, the CKD code list reaches both diagnosis scans, and the per-year
    tables are partition-pruned."""
    run = StagingRun(TableInputs(spark, warehouse), CFG)
    lab_plan = _plan(run.lab_summary)
    pushed = lab_plan.split("PushedFilters:")[1][:400]
    assert "date_servicebegin" in pushed and "requestcpt" in pushed, pushed
    dx_plan = _plan(run.dx_final)
    scans = [seg[:600] for seg in dx_plan.split("FileScan")[1:] if "dx_code" in seg[:600]]
    assert len(scans) == 2
    for seg in scans:
        assert "In(dx_code" in seg and "PartitionFilters: [isnotnull(year" in seg, seg
    claims_plan = _plan(run.claim_prep)
    assert "Not(EqualTo(claim_status,1))" in claims_plan


def test_catalog_inputs_with_year_suffixed_names(spark):
    """Fixed-name and year-suffixed catalog tables resolve like the fixtures."""
    from stagewise import CatalogInputs
    fx = DriverFixtures(spark, SF_SMALL)
    names = {}
    for name, (_, per_year) in LOGICAL.items():
        if per_year:
            for y in (CFG.year, CFG.prev_year):
                fx.table(name, y).createOrReplaceTempView(f"sw_{name}_{y}")
            names[name] = f"sw_{name}_{{year}}"
        else:
            fx.table(name).createOrReplaceTempView(f"sw_{name}")
            names[name] = f"sw_{name}"
    a = StagingRun(CatalogInputs(spark, names), CFG).final_flags
    b = StagingRun(fx, CFG).final_flags
    assert _rows(a) == _rows(b)
    with pytest.raises(ValueError):      # a year-suffixed pattern for a table read without a year
        CatalogInputs(spark, {"claim_headers": "x_{year}"}).table("claim_headers")


def test_member_grain_properties(spark):
    """final_flags has exactly one row per enrolled member; the diagnosis stage
    has one row per member with a dated CKD diagnosis; refinement keeps counts."""
    run = StagingRun(DriverFixtures(spark, "/root/testdata/sf0.01"), CFG)
    ff = run.final_flags
    enrolled = run.inputs.table("enroll", CFG.year).select("member_id").distinct().count()
    assert ff.count() == ff.select("member_id").distinct().count() == enrolled
    dx = run.dx_final
    assert dx.count() == dx.select("member_id").distinct().count() == run.latest_dx.count()
    assert run.member_jvhl.count() == enrolled


def test_cli_writes_report_and_text(spark, tmp_path):
    from stagewise.__main__ import main
    out, text = tmp_path / "rep", tmp_path / "report.txt"
    assert main(["--year", "1997", "--fixtures", SF_SMALL, "--out", str(out),
                 "--no-diagnostics", "--text", str(text)]) == 0
    body = text.read_text()
    assert "stage_frequencies" in body and "crosstab_battery" not in body
    assert any(p.name.startswith("run_date=") for p in (out / "year=1997").iterdir())


def test_table_inputs_year_suffixed_folders(spark):
    root = tempfile.mkdtemp(prefix="stagewise-sfx-")
    fx = DriverFixtures(spark, SF_SMALL)
    for name, (_, per_year) in LOGICAL.items():
        if per_year:
            for y in (CFG.year, CFG.prev_year):
                fx.table(name, y).write.parquet(f"{root}/{name}_{y}")
        else:
            fx.table(name).write.parquet(f"{root}/{name}")
    a = StagingRun(TableInputs(spark, root, layout="suffixed"), CFG).final_flags
    assert _rows(a) == _rows(StagingRun(fx, CFG).final_flags)


def test_qa_lab_filter_reaches_the_scan(spark, warehouse):
    run = StagingRun(TableInputs(spark, warehouse), CFG)
    df = frequency.qa_frequencies(run.labs_normalised, run.latest_lab, run.final_flags, CFG)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        scans = [x for x in _plan(df).splitlines() if "FileScan" in x and "/labs]" in x]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert scans and all("EqualTo(requestcpt" in x.split("PushedFilters")[1] for x in scans)


def test_driver_lists_and_text_are_bounded(spark):
    df = spark.range(20).selectExpr("CAST(id AS STRING) AS v")
    assert len(frequency.category_list(df, "v", most=20)) == 20
    with pytest.raises(ValueError, match="more than 5"):
        frequency.category_list(df, "v", most=5)
    assert "more than 5 rows" in render_text({"free text": df}, most=5)
    assert "more than" not in render_text({"codes": df}, most=20)
