"""Input resolution: schemas, the (name, year) resolver, fixtures, inline values."""

from .bucketed import write_bucketed
from .catalog import CatalogInputs, FrameInputs, Inputs, TableInputs, conform
from .fixtures import DriverFixtures
from .named import NamedTables
from .schemas import LOGICAL
from .values import values_table

__all__ = ["Inputs", "TableInputs", "CatalogInputs", "FrameInputs", "DriverFixtures", "conform",
           "LOGICAL", "NamedTables", "values_table", "write_bucketed"]
