"""Imports every catalogue, so that all queries are registered."""

from stormline.catalog import aggregates, alerting, contrasts, detecting, facts, flows, functions, impacts, joins, matrices, modelling, more, overlays, pipelines, quality, replication, streams, windows  # noqa: F401
from stormline.registry import ORACLES, QUERIES  # noqa: F401
