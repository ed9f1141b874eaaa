"""Numeric/threshold parsing traps: whole-number rounding, input-column reads,
anchored pattern, lenient vs strict casts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise.config import RunConfig
from stagewise.functions.parsing import dx_number, is_threshold_text
from stagewise.operators.labs import normalise_labs

D = dt.date(1997, 3, 1)


def _labs(spark, rows):
    return spark.createDataFrame(
        [(1, "33914-3", n, t, D) for n, t in rows],
        "member_id long, requestcpt string, numericresult string, textresult string, date_servicebegin date")


def test_numeric_text_rounds_half_away_from_zero(spark):
    rows = [("NULL", None), (None, None), ("59.4", None), ("59.5", None), ("59.6", None),
            (" 60 ", None), ("58.5", None)]
    out = normalise_labs(_labs(spark, rows), RunConfig()).select("numericresult", "all_results").collect()
    got = [(r[0], r[1]) for r in out]
    assert got == [(None, None), (None, None), (Decimal(59), Decimal(59)), (Decimal(60), Decimal(60)),
                   (Decimal(60), Decimal(60)), (Decimal(60), Decimal(60)), (Decimal(59), Decimal(59))]


def test_all_results_reads_input_text_not_parsed_value(spark):
    # numericresult "NULL" -> numeric NULL and all_results NULL (not the parsed column)
    out = normalise_labs(_labs(spark, [("NULL", "x")]), RunConfig()).first()
    assert out["numericresult"] is None and out["all_results"] is None


@pytest.mark.parametrize("text,expected", [
    (">60", 60), (">/=60", 60), (">= 90", 90), ("> 60", 60), (">60.00", 60), (">120.0", 120),
    (">600", 600), (">60+", None), ("x>60", None), (">60 mL/min", None), ("60", None), (">60\n", None),
])
def test_threshold_text_whole_string_match(spark, text, expected):
    out = normalise_labs(_labs(spark, [("NULL", text)]), RunConfig()).first()
    assert out["all_results"] == (Decimal(expected) if expected is not None else None)


def test_threshold_pattern_is_anchored(spark):
    df = spark.createDataFrame([(">60 mL/min",), (">60",), (">60+",)], "t string")
    got = [r[0] for r in df.select(is_threshold_text(F.col("t"))).collect()]
    assert got == [False, True, True]   # '>60+' passes the pattern, then fails the cast


def test_strict_cast_raises(spark):
    df = _labs(spark, [("NULL", ">60+")])
    with pytest.raises(Exception):
        normalise_labs(df, RunConfig(strict_cast=True)).collect()


def test_year_window_keeps_two_years(spark):
    df = spark.createDataFrame(
        [(1, "33914-3", "50", None, dt.date(y, 6, 1)) for y in (1995, 1996, 1997, 1998)],
        "member_id long, requestcpt string, numericresult string, textresult string, date_servicebegin date")
    years = sorted(r[0].year for r in normalise_labs(df, RunConfig(year=1997))
                   .select("date_servicebegin").collect())
    assert years == [1996, 1997]


def test_dx_number(spark):
    df = spark.createDataFrame([("N181",), ("N183",), ("N1830",), ("N1832",), ("N18",), ("N18321",)], "c string")
    got = [r[0] for r in df.select(dx_number(F.col("c"))).collect()]
    assert got == [Decimal(1810), Decimal(1830), Decimal(1830), Decimal(1832), None, None]


def test_year_filter_pushed_to_scan(spark, tmp_path):
    p = str(tmp_path / "labs")
    _labs(spark, [("50", None)]).write.parquet(p)
    plan = normalise_labs(spark.read.parquet(p), RunConfig())._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "date_servicebegin" in plan.split("PushedFilters")[1][:300]
