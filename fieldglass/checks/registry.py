"""All registered queries: importing the modules fills the tables."""

from . import encode, models, plans, profile, schema, selection, series, sources, streaming  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
