"""All named queries. Importing the modules fills the registry."""

from loamwork.plans import features, joining, learning, reporting, tabular, texts  # noqa: F401
from loamwork.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
