"""Whole-run plans: the lazy staging graph and the report writer."""

from .report import render_text, report_sections, write_report
from .staging_run import StagingRun
from .textreport import write_text

__all__ = ["StagingRun", "report_sections", "write_report", "render_text", "write_text"]
