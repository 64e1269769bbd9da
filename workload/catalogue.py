"""Importing this module registers every query."""

from workload import aggregates, backtests, files, from_files, joins, peer_scores, resampling, rows, windows  # noqa: F401
from workload.base import COVERS, ORACLES, QUERIES  # noqa: F401
