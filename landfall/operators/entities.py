"""Discovery of the schema versions that occur, and the skip list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.names import CONTEXTS, UNSTRUCT
from landfall.functions.schema_uri import FORMAT, Criterion, key_of, key_parts, matches_any
from landfall.operators.parse import CONTEXT_ITEMS, FAILURE, UNSTRUCT_ITEM

ENTITY = ("kind", "vendor", "name", "model")
VERSION = ("revision", "addition")
SEEN = (*ENTITY, *VERSION)
SEEN_KEY = ("kind", "key")


def spread_items(parsed: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per item of each row: ``position``, ``kind``, ``key``, and the given columns.

    Every row has a position 0, which is its own event's item; the key is NULL there when
    it has none, or when the row failed. Context items follow from position 1.
    """
    uris = f"concat(array({UNSTRUCT_ITEM}.schema), {CONTEXT_ITEMS}.schema)"
    none = "array(CAST(NULL AS STRING))"
    items = F.expr(f"posexplode(CASE WHEN {FAILURE} IS NULL THEN {uris} ELSE {none} END)")
    return parsed.select(*columns, items.alias("position", "uri")).select(
        "*",
        F.expr(f"CASE WHEN position = 0 THEN '{UNSTRUCT}' ELSE '{CONTEXTS}' END AS kind"),
        F.expr(f"{key_of('uri')} AS key"),
    )


def discover_entities(parsed: DataFrame) -> DataFrame:
    """One row per schema version among good rows, with how many items carry it.

    Partial aggregation shrinks each task's rows to its distinct versions before the
    shuffle, so a schema that fills a third of the rows is no hot spot.
    """
    items = spread_items(parsed).where(F.col("key").isNotNull())
    counted = items.groupBy(*SEEN_KEY).agg(F.count("*").alias("items"))
    return counted.select("kind", *key_parts("key"), "items")


def skip_schemas(discovered: DataFrame, criteria: list[Criterion]) -> DataFrame:
    """Drop the versions that a criterion matches; they get no column."""
    key = f"concat_ws('/', vendor, name, '{FORMAT}', concat_ws('-', model, revision, addition))"
    return discovered.where(f"NOT {matches_any(criteria, key)}")


def entity_versions(discovered: DataFrame) -> DataFrame:
    """One row per entity with the set of its ``revision-addition`` versions."""
    version = F.concat_ws("-", *[F.col(p).cast("string") for p in VERSION])
    return discovered.groupBy(*ENTITY).agg(F.sort_array(F.collect_set(version)).alias("versions"))
