"""Queries on the given tables."""

from corpusgate.bindings import aggregates, expressions, intake, joins, sequences  # noqa: F401
from corpusgate.bindings.base import COVERS, ORACLES, QUERIES

__all__ = ["COVERS", "ORACLES", "QUERIES"]
