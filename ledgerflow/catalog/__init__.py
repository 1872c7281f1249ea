"""The registered queries, each with the SQL it is checked against where SQL can say it."""

from ledgerflow.catalog import batch, checked, explain, features, live, model, sources, windows  # noqa: F401
from ledgerflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
