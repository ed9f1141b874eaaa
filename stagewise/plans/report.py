"""The run's report: every table written as its own dataset under one folder.

Layout (``S9``): ``<root>/year=<Y>/run_date=<D>/<section>/`` with ``test_``
prefixed sections for sampled runs.  Report tables are small (bounded by label
combinations), but they are still written by Spark tasks, never collected.

``final_flags`` is checkpointed once (lineage cut into the cluster's shared
checkpoint folder) because most sections re-read it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..operators import frequency, members, quality
from ..sources.catalog import Inputs
from ..sources.named import NamedTables
from .staging_run import StagingRun
from .textreport import write_text


def report_sections(run: StagingRun) -> dict[str, Callable[[], DataFrame]]:
    """Section name -> lazily built frame, in report order.

    All member-level frequency sections read one shared report cuboid, so the
    member flags are aggregated once for 43 tables.
    """
    cfg = run.cfg
    shared: dict[str, DataFrame] = {}

    def cube() -> DataFrame:
        if "cube" not in shared:
            shared["cube"] = run._keep("report_cuboid", lambda: frequency.report_cuboid(run.final_flags, cfg))
        return shared["cube"]

    sections: dict[str, Callable[[], DataFrame]] = {
        "flag_minus_esrd_count": lambda: members.flag_minus_esrd_count(run.final_flags).select(
            F.lit("Beneficiaries flagged as CKD from JVHL data and ESRD").alias("title"), "n"),
        "stage_frequencies": lambda: frequency.stage_frequencies(run.final_flags, cfg, base=cube()),
        "qa_frequencies": lambda: frequency.qa_frequencies(run.labs_normalised, run.latest_lab,
                                                           run.final_flags, cfg, base=cube()),
        "qa_both_sources_sample": lambda: quality.qa_both_sources_sample(run.final_flags),
        "dx_parity": lambda: run.dx_parity,
        "data_quality": lambda: quality.data_quality(run.inputs, cfg, run.lab_parse_failures),
    }
    if cfg.diagnostics:
        sections.update({
            "crosstab_battery": lambda: frequency.crosstab_battery(run.final_flags, cfg, base=cube()),
            "monthly_counts": lambda: frequency.monthly_counts(run.final_flags).select(
                F.lit(f"Monthly counts of claims and labs in {cfg.year}").alias("title"), "*"),
            "cost_battery": lambda: run.cost_battery,
        })
    return sections


def report_path(root: str, cfg: RunConfig, run_date: dt.date | None = None) -> str:
    return f"{root.rstrip('/')}/year={cfg.year}/run_date={(run_date or dt.date.today()).isoformat()}"


#: The sections of the titled text, in its order; the others are checks beside it.
TEXT_SECTIONS = ("flag_minus_esrd_count", "stage_frequencies", "crosstab_battery", "monthly_counts", "cost_battery")


def write_report(inputs: Inputs, cfg: RunConfig, root: str, run_date: dt.date | None = None,
                 materialize_mode: str = "checkpoint", fmt: str = "parquet",
                 concurrency: int = 4, resume: str | None = None, text: bool = False,
                 spark: SparkSession | None = None) -> dict[str, str]:
    """Build the run, write every section, return section -> path.

    The refinement parity check is enforced and the shared member-level frames
    are materialised first; the sections are independent outputs, so up to
    ``concurrency`` of them are submitted as concurrent Spark jobs (the
    scheduler interleaves their tasks).  Writes use overwrite mode, so a re-run
    after a failure replaces partial output.

    ``resume`` names the run: its shared frames and its sections are then named
    tables under the report's folder (Parquet), committed one by one, and a run
    started again with the same name, settings and folder reads what it had
    finished.  Inputs that changed need another name.

    ``text`` also writes the titled tables as one text dataset (section ``text``).
    """
    base = report_path(root, cfg, run_date)
    if resume is not None and fmt != "parquet":
        raise ValueError("named tables are Parquet")
    spark = spark or SparkSession.active()
    tables = NamedTables(spark, f"{base}/tables", f"{resume} {cfg}") if resume is not None else None
    run = StagingRun(inputs, cfg, materialize_mode=materialize_mode, tables=tables)
    if tables is not None:
        quality.assert_parity(run.dx_parity)
    else:
        run.member_stage, run.latest_dx, run.dx_final      # build the lazy graph on this thread
        with ThreadPoolExecutor(max_workers=2) as pool:    # parity check || final_flags lineage cut
            checks = [pool.submit(quality.assert_parity, run.dx_parity), pool.submit(lambda: run.final_flags)]
            for f in checks:
                f.result()
    sections = report_sections(run)

    def write(name: str) -> tuple[str, str]:
        if tables is not None:
            tables.frame(name, lambda: frames[name])
            return name, tables.path(name)
        path = f"{base}/{name}"
        frames[name].write.mode("overwrite").format(fmt).save(path)
        return name, path

    try:
        frames = {name: build() for name, build in sections.items()}
        with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
            done = dict(pool.map(write, frames))
        paths = {n: done[n] for n in frames}
        if text:
            titled = {n: spark.read.format(fmt).load(paths[n]) for n in TEXT_SECTIONS if n in paths}
            paths["text"] = write_text(titled, f"{base}/text")
        return paths
    finally:
        run.release()


def render_text(tables: dict[str, DataFrame], most: int = 10_000) -> str:
    """Titled fixed-width text of report frames.

    Most report frames are bounded by label combinations (a few hundred rows).
    One of more than ``most`` rows (free-text results) isn't collected: its
    text is a line that says so, and its rows are in the report dataset.
    """
    parts = []
    for name, df in tables.items():
        cols = df.columns
        rows = df.orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(most + 1).collect()
        if len(rows) > most:
            parts.append(f"{name}\nmore than {most} rows: see the report dataset\n")
            continue
        cells = [[("" if r[c] is None else str(r[c])) for c in cols] for r in rows]
        width = [max([len(c)] + [len(x[i]) for x in cells]) for i, c in enumerate(cols)]
        lines = [" ".join(c.rjust(w) for c, w in zip(cols, width))]
        lines += [" ".join(x.rjust(w) for x, w in zip(row, width)) for row in cells]
        parts.append(name + "\n" + "\n".join(lines) + "\n")
    return "\n".join(parts)
