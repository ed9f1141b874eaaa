"""DataFrame operators of the staging and cost analysis."""

from . import costs, diagnoses, frequency, labs, latest, members, quality, staging

__all__ = ["costs", "diagnoses", "frequency", "labs", "latest", "members", "quality", "staging"]
