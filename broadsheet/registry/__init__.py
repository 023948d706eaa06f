"""Registered queries over the given tables, each with its SQL twin where SQL can say it."""

from broadsheet.registry import cleaning, extraction, features, measures, models, sampling, scalars
from broadsheet.registry.base import QUERIES

__all__ = ["QUERIES", "cleaning", "extraction", "features", "measures", "models", "sampling", "scalars"]
