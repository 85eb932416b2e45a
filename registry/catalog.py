"""All registered queries and oracles."""

from registry.files import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
