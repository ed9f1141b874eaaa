"""Randomised differential test: small logical inputs full of edge cases
(NULL keys and dates, duplicate enrolment months, duplicate category and header
rows, NULL statuses, malformed lab texts, duplicate member rows) are run
through the Spark graph and through the naive DuckDB oracle; every registered
query must agree row for row."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as E
import oracle_sql
from oracle_compare import compare
from stagewise import FrameInputs, RunConfig, StagingRun
from stagewise.sources.schemas import LOGICAL

Y, P = 1997, 1996
TARGET = "33914-3"
NUMERIC = ["NULL", None, "59.4", "59.5", "59.6", "45", "29.5", "14.4", "90", "89.5", "60", "abc", "30"]
TEXT = [None, None, None, ">60", ">/=90", ">= 90", "> 60", ">60.00", ">120.0", ">600", ">60+", "x>60",
        ">60 mL/min", "60", "see note"]
CODES = ["N181", "N182", "N183", "N1830", "N1831", "N1832", "N184", "N185", "I10"]
CATS = ["Inpatient", "INPATIENT", "Clinic", "Drug", "OP Facility", "op facility", "NF", "Dental", None]


def _date(rnd, years=(1996, 1997)):
    return dt.date(rnd.choice(years), rnd.randrange(1, 13), rnd.randrange(1, 28))


def generate(seed: int) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)
    members = list(range(1, 80))
    mid = lambda: None if rnd.random() < 0.03 else rnd.choice(members)
    t = {}
    t["member"] = [(m, rnd.choice([None, 10, 17, 18, 40, 80])) for m in members if rnd.random() < 0.9]
    t["member"] += [(m, 50) for m in rnd.sample(members, 3)]                       # duplicate rows
    enroll = []
    for m in members:
        for month in rnd.sample(range(1, 13), rnd.randrange(1, 8)):
            row = (m, dt.date(Y, month, 1), rnd.choice(["AET", "BCC", "OTH", None, "MER"]),
                   rnd.choice(["Y", "Y", "N", None]), rnd.choice(["Y", "N", "N", None]))
            enroll.append(row)
            if rnd.random() < 0.05:
                enroll.append(row)                                                  # duplicate month
    enroll.append((None, dt.date(Y, 1, 1), "AET", "Y", "N"))
    t["enroll"] = enroll
    for name in ("cond_cur", "cond_prev"):
        rows = [(m, rnd.choice([0, 1, None]), rnd.choice([0, 0, 1, None]), rnd.choice([0, 1, None]))
                for m in members if rnd.random() < 0.8]
        rows += [(m, 1, 0, 1) for m in rnd.sample(members, 2)]                     # duplicate member rows
        t[name] = rows
    t["labs"] = [(mid(), rnd.choice([TARGET, TARGET, "2160-0"]), rnd.choice(NUMERIC), rnd.choice(TEXT),
                  None if rnd.random() < 0.03 else _date(rnd, (1995, 1996, 1997, 1998)).replace(day=1))
                 for _ in range(700)]
    claims_ids = list(range(1000, 1300))
    dx = [(mid(), None if rnd.random() < 0.05 else rnd.choice(claims_ids), rnd.choice(CODES))
          for _ in range(500)]
    t["dx_cur"] = dx[:300]
    t["dx_prev"] = dx[250:]                                                          # overlap -> union dedupe
    t["headers"] = [(c, None if rnd.random() < 0.05 else _date(rnd)) for c in claims_ids if rnd.random() < 0.9]
    t["headers"] += [(c, _date(rnd)) for c in rnd.sample(claims_ids, 5)]            # duplicate headers
    t["claims"] = [(rnd.choice(claims_ids), mid(), None if rnd.random() < 0.03 else _date(rnd, (1997,)),
                    None if rnd.random() < 0.05 else Decimal(rnd.randrange(100, 100000)) / 100,
                    rnd.choice([0, 1, 2, None])) for _ in range(900)]
    t["category"] = [(c, rnd.choice(CATS)) for c in claims_ids if rnd.random() < 0.9]
    t["category"] += [(c, "Clinic") for c in rnd.sample(claims_ids, 8)]              # duplicate category rows
    t["ip"] = [(c, None if rnd.random() < 0.1 else Decimal(rnd.randrange(100, 500000)) / 100)
               for c in claims_ids if rnd.random() < 0.4]
    t["ip"] += [(c, Decimal("12.34")) for c in rnd.sample(claims_ids, 4)]           # duplicate headers
    return t


LOGICAL_OF = {"member": "member", "enroll": "enroll", "cond_cur": "condition_flags",
              "cond_prev": "condition_flags", "labs": "labs", "dx_cur": "dx_long", "dx_prev": "dx_long",
              "headers": "claim_headers", "claims": "claims", "category": "claim_category",
              "ip": "inpatient_header"}
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "date": pa.date32(),
         "decimal(18,2)": pa.decimal128(18, 2)}


def _arrow(rows, schema):
    cols = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    fields = [pa.field(f.name, ARROW[f.dataType.simpleString().replace("bigint", "long")])
              for f in schema.fields]
    return pa.table([pa.array(list(c), type=f.type) for c, f in zip(cols, fields)],
                    schema=pa.schema(fields))


@pytest.fixture(scope="module", params=[11, 29])
def case(request, spark):
    data = generate(request.param)
    con = duckdb.connect()
    frames = {}
    for name, rows in data.items():
        schema, _ = LOGICAL[LOGICAL_OF[name]]
        con.register(f"fx_{name}", _arrow(rows, schema))
        frames[name] = spark.createDataFrame(rows, schema)
    by_year = {
        "labs": frames["labs"], "claim_headers": frames["headers"],
        "enroll": {Y: frames["enroll"]}, "member": {Y: frames["member"]},
        "condition_flags": {Y: frames["cond_cur"], P: frames["cond_prev"]},
        "dx_long": {Y: frames["dx_cur"], P: frames["dx_prev"]},
        "claims": {Y: frames["claims"]}, "claim_category": {Y: frames["category"]},
        "inpatient_header": {Y: frames["ip"]},
    }
    return StagingRun(FrameInputs(by_year), RunConfig(year=Y)), con


QUERIES = sorted(oracle_sql.oracle_sql(fixtures=False))


@pytest.mark.parametrize("name", QUERIES)
def test_random_inputs_match_oracle(case, name):
    run, con = case
    df = E.canonical(E._REGISTRY[name](run))
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql.oracle_sql(fixtures=False)[name])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg
