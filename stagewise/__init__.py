"""stagewise - cohort kidney-disease staging and cost reports on Spark DataFrames."""

from .config import RunConfig
from .plans.staging_run import StagingRun
from .sources import CatalogInputs, DriverFixtures, FrameInputs, TableInputs

__all__ = ["RunConfig", "StagingRun", "CatalogInputs", "DriverFixtures", "FrameInputs", "TableInputs"]
