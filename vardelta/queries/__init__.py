"""Registered queries, each with the SQL that checks it where SQL can express it."""

from vardelta.queries import delta, family, genotypes, predicates, streams, upkeep
from vardelta.queries._base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "delta", "family", "genotypes", "predicates", "streams", "upkeep"]
