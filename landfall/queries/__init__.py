"""Every operator run over the driver's tables, each beside the SQL it must agree with."""

from landfall.queries import batches, entities, landing, lines, metrics, streams
from landfall.queries.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batches", "entities", "landing", "lines", "metrics", "streams"]
