"""Queries on the given tables, one per operator, view and pipeline."""

from forecourt.standins import latests, matches, merges, payloads, rollups, scalars  # noqa: F401
from forecourt.standins import files, pipelines, streams  # noqa: F401
from forecourt.standins.base import ORACLE, QUERIES  # noqa: F401
