"""Run the staging analysis and write its report.

    python -m stagewise --year 1997 --warehouse /shared/warehouse --out /shared/reports
    python -m stagewise --year 1997 --fixtures /root/testdata/sf0.01 --out /tmp/r --text /tmp/r.txt

``--warehouse``: one parquet dataset per logical table (year-partitioned where
per-year); ``--fixtures``: derive the inputs from the driver tables instead.
Uses the active/default Spark session configuration (spark-submit settings).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import RunConfig
from .plans.report import render_text, write_report
from .sources import DriverFixtures, TableInputs


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stagewise", description=__doc__.split("\n\n")[0])
    ap.add_argument("--year", type=int, required=True, help="analysis year (yyyy)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--warehouse", help="root of the logical input tables")
    src.add_argument("--fixtures", help="folder with the driver tables to derive inputs from")
    ap.add_argument("--out", required=True, help="report root folder")
    ap.add_argument("--strict-cast", action="store_true", help="fail on unparseable numeric text instead of NULL")
    ap.add_argument("--no-diagnostics", action="store_true", help="skip crosstab/monthly/cost sections")
    ap.add_argument("--fix-quirks", action="store_true", help="repair the switchable source quirks")
    ap.add_argument("--text", default=None, help="also render the report tables as titled text here")
    ap.add_argument("--text-dataset", action="store_true", help="write the titled tables as one text dataset under --out")
    ap.add_argument("--resume", default=None, metavar="RUN", help="name of the run: started again, it reads what it had finished")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("stagewise").getOrCreate()
    cfg = RunConfig(year=args.year, strict_cast=args.strict_cast, diagnostics=not args.no_diagnostics,
                    fix_quirks=args.fix_quirks)
    inputs = (TableInputs(spark, args.warehouse) if args.warehouse
              else DriverFixtures(spark, args.fixtures, analysis_year=args.year))
    paths = write_report(inputs, cfg, args.out, resume=args.resume, text=args.text_dataset, spark=spark)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    if args.text:
        tables = {name: spark.read.parquet(path) for name, path in paths.items() if name != "text"}
        with open(args.text, "w") as f:
            f.write(render_text(tables))
    return 0


if __name__ == "__main__":
    sys.exit(main())
