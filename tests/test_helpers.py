"""Property tests for the order-preserving key and the SQL-text helpers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stagewise.functions import sqltext as Q
from stagewise.operators.latest import date_code_key, key_code, key_date


def test_date_code_key_orders_like_the_tuple_and_round_trips(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(400):
        d = dt.date(1900, 1, 1) + dt.timedelta(days=rnd.randrange(0, 60000))   # spans 1970
        code = rnd.choice([None, 0, 1, 1830, 1831, 9999, 99998])
        rows.append((d, code))
    df = spark.createDataFrame(rows, "d date, c long")
    k = date_code_key(F.col("d"), F.col("c"))
    got = df.select("d", "c", k.alias("k"), key_date(k).alias("kd"), key_code(k).alias("kc")).collect()
    for r in got:
        assert (r["kd"], r["kc"]) == (r["d"], r["c"])                          # exact round trip
    by_key = sorted(got, key=lambda r: r["k"])
    by_tuple = sorted(got, key=lambda r: (r["d"], -1 if r["c"] is None else r["c"]))
    assert [(r["d"], r["c"]) for r in by_key] == [(r["d"], r["c"]) for r in by_tuple]


def test_date_code_key_null_date_is_null(spark):
    df = spark.createDataFrame([(None, 5)], "d date, c long")
    assert df.select(date_code_key(F.col("d"), F.col("c"))).first()[0] is None


def test_sql_literals_round_trip(spark):
    values = ["plain", "it's", "back\\slash", "dual_flag='Y'", "", None, 7, 2.5, True]
    row = spark.range(1).select(*[F.expr(Q.lit(v)).alias(f"c{i}") for i, v in enumerate(values)]).first()
    assert list(row) == values


def test_unpivot_rows_emits_only_matching_records(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b")], "x int, s string")
    rows = [("x > 2", [("tag", Q.lit("big")), ("val", "s")]),
            (None, [("tag", Q.lit("any")), ("val", "s")])]
    got = sorted(tuple(r) for r in df.select(Q.unpivot_rows(rows)).collect())
    assert got == [("any", "a"), ("any", "b"), ("big", "b")]


def test_dx_parity_can_fail(spark):
    import datetime
    from stagewise.operators import quality
    day = datetime.date(2020, 1, 1)
    bag = spark.createDataFrame([(1, day), (1, day), (2, day), (3, None)], "member_id long, from_date date")
    good = spark.createDataFrame([(1,), (2,)], "member_id long")
    assert tuple(quality.dx_parity(bag, good).first()) == (2, 2, True)
    for bad in ([(1,)], [(1,), (1,)], [(1,), (2,), (3,)]):
        assert not quality.dx_parity(bag, spark.createDataFrame(bad, "member_id long")).first()["parity"]


def test_dx_parity_ignores_rows_without_a_member(spark):
    from stagewise.operators import quality
    bag = spark.createDataFrame([(1, dt.date(1997, 1, 1)), (None, dt.date(1997, 1, 1))], "member_id long, from_date date")
    final = spark.createDataFrame([(1,)], "member_id long")
    assert tuple(quality.dx_parity(bag, final).first()) == (1, 1, True)



def test_frequency_by_expression(spark):
    from pyspark.sql import functions as F
    from stagewise.operators.frequency import frequency
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    got = frequency(df, [(F.col("x") % 2).alias("odd")]).collect()
    assert [tuple(r) for r in got] == [(0, 1), (1, 2), (None, 1)]
