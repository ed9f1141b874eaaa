"""Condensed physical plans: the operator tree without expression detail.

    python -m stagewise.plans.explain <sf_dir> [--no-broadcast] > docs/PLANS.md

``--no-broadcast`` plans with broadcast joins disabled, i.e. the shape the
plans take when no side is small enough to broadcast (the 100 TB case).
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame

_KEEP = re.compile(r"(Exchange|Join|Aggregate|Generate|Scan|Union|TakeOrdered|Window|Sort |Expand)")


def plan_outline(df: DataFrame) -> str:
    """Indented operator names (with join/exchange keys) of the executed plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([ :|+\-]*)(.*)$", line)
        prefix, body = m.group(1), m.group(2)
        if not _KEEP.search(body):
            continue
        depth = len(prefix) // 3
        if body.startswith("FileScan") or body.startswith("Scan"):
            name = re.search(r"Location: \w+\(\d+ paths?\)\[([^\]]*)\]", body)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", body)
            body = "Scan " + (name.group(1).rsplit("/", 1)[-1] if name else "")
            if pushed and pushed.group(1):
                body += f"  pushed: {pushed.group(1)[:80]}"
        else:
            body = re.sub(r"#\d+L?", "", body)
            body = re.sub(r", functions=\[.*?\]\)?, output=.*$", ")", body)
            body = re.sub(r"\[plan_id=\d+\]", "", body)
            body = body[:120]
        out.append("  " * depth + body)
    return "\n".join(out)


def main(argv: list[str]) -> None:
    from ..config import RunConfig
    from ..session import local_session
    from ..sources import DriverFixtures
    from .staging_run import StagingRun

    sf_dir = argv[0]
    spark = local_session()
    if "--no-broadcast" in argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    run = StagingRun(DriverFixtures(spark, sf_dir), RunConfig())
    from ..operators import frequency
    frames = {
        "final_flags": run.final_flags,
        "crosstab_battery": frequency.crosstab_battery(run.final_flags, run.cfg),
        "claim_prep": run.claim_prep,
        "cost_battery": run.cost_battery,
    }
    print("# Physical plan outlines\n")
    print(f"Planned on `{sf_dir}`" + (" with broadcast joins disabled" if "--no-broadcast" in argv else "")
          + " by `python -m stagewise.plans.explain`.\n")
    for name, df in frames.items():
        print(f"## {name}\n\n```\n{plan_outline(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
