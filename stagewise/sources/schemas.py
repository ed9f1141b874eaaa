"""Declared schemas of the logical inputs (columns the staging rules read)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

LABS = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("requestcpt", T.StringType()),
    T.StructField("numericresult", T.StringType()),
    T.StructField("textresult", T.StringType()),
    T.StructField("date_servicebegin", T.DateType()),
])

ENROLL = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("begin_date", T.DateType()),
    T.StructField("mhp", T.StringType()),
    T.StructField("medical_flag", T.StringType()),
    T.StructField("dual_flag", T.StringType()),
])

CONDITION_FLAGS = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("ckd", T.IntegerType()),
    T.StructField("esrd", T.IntegerType()),
    T.StructField("aki", T.IntegerType()),
])

MEMBER = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("age", T.IntegerType()),
])

DX_LONG = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("claim_id", T.LongType()),
    T.StructField("dx_code", T.StringType()),
])

CLAIM_HEADERS = T.StructType([
    T.StructField("claim_id", T.LongType()),
    T.StructField("from_date", T.DateType()),
])

CLAIMS = T.StructType([
    T.StructField("claim_id", T.LongType()),
    T.StructField("member_id", T.LongType()),
    T.StructField("from_date", T.DateType()),
    T.StructField("allowed_amt", MONEY),
    T.StructField("claim_status", T.IntegerType()),
])

CLAIM_CATEGORY = T.StructType([
    T.StructField("claim_id", T.LongType()),
    T.StructField("fasc_cat", T.StringType()),
])

INPATIENT_HEADER = T.StructType([
    T.StructField("claim_id", T.LongType()),
    T.StructField("allowed_amount", MONEY),
])

#: Identifiers: their type is the source's own (numbers or text), unless the resolver is told another.
KEYS = ("member_id", "claim_id")
#: Tables whose whole rows count (a UNION compares every column, and all come out): undeclared columns stay.
WHOLE_ROWS = ("dx_long",)

# logical name -> (schema, is the table year-specific?)
LOGICAL = {
    "labs": (LABS, False),
    "enroll": (ENROLL, True),
    "condition_flags": (CONDITION_FLAGS, True),
    "member": (MEMBER, True),
    "dx_long": (DX_LONG, True),
    "claim_headers": (CLAIM_HEADERS, False),
    "claims": (CLAIMS, True),
    "claim_category": (CLAIM_CATEGORY, True),
    "inpatient_header": (INPATIENT_HEADER, True),
}
