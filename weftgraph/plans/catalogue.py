"""All registered queries."""

from . import changes, hops, predicates, profiles, rules, scalars, scans, search, shaping, stores
from .registry import ORACLES, QUERIES

MODULES = (changes, hops, predicates, profiles, rules, scalars, scans, search, shaping, stores)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
