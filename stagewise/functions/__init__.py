"""Column-level building blocks: parsing, rule tables, predicates."""

from . import parsing, predicates, rules

__all__ = ["parsing", "predicates", "rules"]
