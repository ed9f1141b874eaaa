"""Claim tables bucketed by claim, for runs that read them again.

Line aggregates, category and header joins and the final claim aggregate are all
keyed by ``claim_id``.  Tables bucketed (and sorted) by it in equally many
buckets are read already dealt out, so the whole claim preparation needs no
exchange.  A claim with a third of all lines is then whole in one bucket, where
its lines are summed as they are read; leave tables with such claims unbucketed,
and the lines are summed before they move.
"""

from __future__ import annotations

from .catalog import CatalogInputs, Inputs

CLAIM_TABLES = ("claims", "claim_category", "inpatient_header")


def write_bucketed(inputs: Inputs, year: int, root: str, buckets: int, prefix: str = "") -> CatalogInputs:
    """Write the year's claim tables below ``root`` as catalog tables ``<prefix><name>_<year>``, bucketed by
    ``claim_id``, and return their resolver."""
    spark = None
    for name in CLAIM_TABLES:
        df = inputs.table(name, year)
        spark = df.sparkSession
        # one file a bucket: rows are dealt out as the buckets are
        (df.repartition(buckets, "claim_id").write.mode("overwrite").format("parquet")
           .option("path", f"{root.rstrip('/')}/{name}_{year}")
           .bucketBy(buckets, "claim_id").sortBy("claim_id").saveAsTable(f"{prefix}{name}_{year}"))
    return CatalogInputs(spark, {name: f"{prefix}{name}_{{year}}" for name in CLAIM_TABLES})
