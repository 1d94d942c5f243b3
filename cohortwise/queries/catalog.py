"""All registered queries."""

from cohortwise.queries import derived, encodings, fills, learned, profiles, ruled, scored, streams, tables  # noqa: F401  (imported to register)
from cohortwise.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
