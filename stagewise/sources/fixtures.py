"""Derive the nine logical inputs from the driver's TPC-H-style tables.

The driver tables (``customer``, ``orders``, ``lineitem``) carry no health data,
so each logical input is a deterministic projection of them (rules in
FIXTURES.md section 2).  Only integer arithmetic, CASE and string building are
used, so the DuckDB oracle derives exactly the same rows.  The derivation is
ordinary Spark: scans with pushed year ranges, one equi-join of lineitem to
orders, and a per-customer ``explode`` for the monthly enrolment rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TARGET_TEST_CODE
from .catalog import Inputs

# FIXED VALUES of the fixture rules (FIXTURES.md section 2).
FIXTURE_YEAR = 1997
OTHER_TEST_CODE = "2160-0"
FREE_TEXT_RESULT = "see comment"
DX_BY_ORDERKEY_MOD16 = ("N181", "N182", "N183", "N1830", "N1831", "N1832", "N184", "N185")
DX_OTHER = "I10"
PLAN_BY_SEGMENT = (("AUTOMOBILE", "AET"), ("BUILDING", "BCC"))
PLAN_OTHER = "OTH"
CATEGORY_BY_PRIORITY = (("1", "Inpatient"), ("2", "Clinic"), ("3", "Drug"), ("4", "OP Facility"))
CATEGORY_PRIORITY5_BY_MOD3 = ("NF", "Dental", None)


# Read schemas of the driver tables (only the columns the derivation uses):
# declaring them skips the footer-reading inference job on first access.
DRIVER_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_orderstatus STRING",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                "l_tax DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
}


def _year_range(ts: Column, year: int) -> Column:
    """``year(ts) = year`` written as a range so parquet row groups can be pruned."""
    lo = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (ts >= lo) & (ts < hi)


class DriverFixtures(Inputs):
    """Logical inputs derived from ``<sf_dir>/{customer,orders,lineitem}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str, analysis_year: int = FIXTURE_YEAR):
        self.spark, self.sf_dir, self.analysis_year = spark, sf_dir.rstrip("/"), analysis_year
        self._scans: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        # one relation per driver table (file listing and footer read happen once)
        if name not in self._scans:
            self._scans[name] = (self.spark.read.schema(DRIVER_SCHEMAS[name])
                                 .parquet(f"{self.sf_dir}/{name}.parquet"))
        return self._scans[name]

    def _orders(self, year: int | None = None) -> DataFrame:
        o = self._read("orders")
        return o if year is None else o.where(_year_range(F.col("o_orderdate"), year))

    def _load(self, name, year):
        return getattr(self, f"_{name}")(year)

    # -- members -----------------------------------------------------------
    def _member(self, year):
        return self._read("customer").selectExpr(
            "c_custkey AS member_id",
            "CASE WHEN c_custkey % 50 <> 49 THEN CAST(c_custkey % 90 AS INT) END AS age")

    def _enroll(self, year):
        plan = " ".join(f"WHEN '{seg}' THEN '{code}'" for seg, code in PLAN_BY_SEGMENT)
        months = (self._read("customer")
                  .selectExpr("c_custkey", "c_mktsegment",
                              "explode(sequence(1, CAST(1 + c_custkey % 12 AS INT))) AS m"))
        return months.selectExpr(
            "c_custkey AS member_id",
            f"make_date({year}, m, 1) AS begin_date",
            f"CASE c_mktsegment {plan} ELSE '{PLAN_OTHER}' END AS mhp",
            "CASE WHEN (c_custkey + m) % 4 = 0 THEN 'N' ELSE 'Y' END AS medical_flag",
            "CASE WHEN c_custkey % 6 = 0 THEN 'Y' ELSE 'N' END AS dual_flag")

    def _condition_flags(self, year):
        x = f"(c_custkey + {self.analysis_year - year})"
        flag = lambda n: f"CASE WHEN {x} % 10 = 9 THEN NULL WHEN {x} % {n} = 0 THEN 1 ELSE 0 END"
        return self._read("customer").selectExpr(
            "c_custkey AS member_id", f"{flag(3)} AS ckd", f"{flag(17)} AS esrd", f"{flag(5)} AS aki")

    # -- labs ----------------------------------------------------------------
    def _labs(self, year):
        li = self._read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                            "l_tax", "l_returnflag", "l_shipdate")
        o = self._orders().select("o_orderkey", "o_custkey")
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        return j.selectExpr(
            "o_custkey AS member_id",
            f"CASE WHEN l_linenumber <= 2 AND o_custkey % 4 <> 3 THEN '{TARGET_TEST_CODE}' ELSE '{OTHER_TEST_CODE}' END AS requestcpt",
            "CASE WHEN l_linenumber = 2 THEN 'NULL' WHEN l_quantity = 50 THEN CAST(NULL AS STRING) "
            "ELSE concat(CAST(CAST(l_quantity AS INT) * 2 AS STRING), '.', "
            "CAST(CAST(round(l_tax * 100) AS INT) AS STRING)) END AS numericresult",
            "CASE WHEN l_linenumber = 2 THEN CASE l_returnflag WHEN 'A' THEN '>60' "
            f"WHEN 'N' THEN '>/=90' WHEN 'R' THEN '{FREE_TEXT_RESULT}' END END AS textresult",
            "trunc(CAST(l_shipdate AS DATE), 'month') AS date_servicebegin")

    # -- diagnoses and claims -------------------------------------------------
    def _dx_long(self, year):
        arms = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(DX_BY_ORDERKEY_MOD16))
        return self._orders(year).selectExpr(
            "o_custkey AS member_id", "o_orderkey AS claim_id",
            f"CASE o_orderkey % 16 {arms} ELSE '{DX_OTHER}' END AS dx_code",
            "o_orderstatus AS order_status")  # undeclared: whole rows keep it

    def _claim_headers(self, year):
        return self._orders().selectExpr(
            "o_orderkey AS claim_id",
            "CASE WHEN o_orderkey % 40 <> 39 THEN CAST(o_orderdate AS DATE) END AS from_date")

    def _claims(self, year):
        li = self._read("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
        o = self._orders(year).select("o_orderkey", "o_custkey", "o_orderdate")
        return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                  .select(F.col("l_orderkey").alias("claim_id"),
                          F.col("o_custkey").alias("member_id"),
                          F.col("o_orderdate").cast("date").alias("from_date"),
                          F.col("l_extendedprice").cast("decimal(18,2)").alias("allowed_amt"),
                          (F.col("l_linenumber") % 7).cast("int").alias("claim_status")))

    def _claim_category(self, year):
        arms = " ".join(f"WHEN '{p}' THEN '{name}'" for p, name in CATEGORY_BY_PRIORITY)
        low = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(CATEGORY_PRIORITY5_BY_MOD3)
                       if v is not None)
        return self._orders(year).selectExpr(
            "o_orderkey AS claim_id",
            f"CASE substring(o_orderpriority, 1, 1) {arms} "
            f"WHEN '5' THEN CASE o_orderkey % 3 {low} END END AS fasc_cat")

    def _inpatient_header(self, year):
        return self._orders(year).where("substring(o_orderpriority, 1, 1) = '1'").selectExpr(
            "o_orderkey AS claim_id",
            "CASE WHEN o_orderkey % 9 <> 8 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS allowed_amount")
