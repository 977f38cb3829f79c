"""Which entity columns a batch needs, from the schema versions it holds."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

from landfall.functions.names import CONTEXTS, UNSTRUCT, column_name
from landfall.functions.schema_uri import key_text
from landfall.functions.strict_json import landed_type
from landfall.plans.evolve import SubVersion, merge_versions, recovery_suffix


class ClashingSchemas(Exception):
    """Two schemas of one batch ask for the same column."""


@dataclass(frozen=True)
class SeenVersion:
    kind: str
    vendor: str
    name: str
    model: int
    revision: int
    addition: int

    @property
    def entity(self) -> tuple[str, str, str, int]:
        return self.kind, self.vendor, self.name, self.model

    @property
    def schema_key(self) -> tuple[str, str, int]:
        return self.vendor, self.name, self.model

    @property
    def version(self) -> SubVersion:
        return self.revision, self.addition


@dataclass(frozen=True)
class EntityColumn:
    """One output column, filled from items of the given versions of its model."""

    kind: str
    vendor: str
    name: str
    model: int
    column: str
    data_type: T.DataType
    versions: tuple[SubVersion, ...]
    recovered: bool = False

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(key_text(self.vendor, self.name, self.model, *v) for v in self.versions)

    @property
    def output_type(self) -> T.DataType:
        inner = landed_type(self.data_type)
        if self.kind == UNSTRUCT:
            return inner
        if isinstance(inner, T.StructType):
            version = T.StructField("_schema_version", T.StringType(), False)
            inner = T.StructType([version, *inner.fields])
        return T.ArrayType(inner, False)


def plan_columns(
    seen: list[SeenVersion],
    schemas: dict[tuple[str, str, int], dict[SubVersion, str]],
    landed: Mapping[tuple[str, str, str, int], T.DataType] | None = None,
) -> list[EntityColumn]:
    """Merged column of each entity, then its recovery columns, in a fixed order.

    ``schemas`` holds, for each model, the text of its registered versions. Every version
    up to the newest one seen takes part in the merge, so that a column gets the same type
    from a batch holding only the newest version as from one holding them all. Recovery
    columns are made only for versions that occur. ``landed`` holds the types that columns
    of entities have already (``sources.ledger``); these are kept and only added to.
    """
    landed = landed or {}
    versions: dict[tuple, set[SubVersion]] = defaultdict(set)
    for item in seen:
        versions[item.entity].add(item.version)
    order = {UNSTRUCT: 0, CONTEXTS: 1}
    columns: list[EntityColumn] = []
    for entity in sorted(versions, key=lambda e: (order[e[0]], *e[1:])):
        kind, vendor, name, model = entity
        newest = max(versions[entity])
        texts = {v: s for v, s in schemas[entity[1:]].items() if v <= newest}
        evolution = merge_versions(texts, landed.get(entity))
        if evolution.merged is None:
            continue
        base = column_name(kind, vendor, name, model)
        fits = tuple(sorted(versions[entity] - set(evolution.recovered)))
        columns.append(EntityColumn(*entity, base, evolution.merged, fits))
        for version, broken in sorted(evolution.recovered.items()):
            if version in versions[entity]:
                suffix = recovery_suffix(model, version, broken)
                columns.append(EntityColumn(*entity, base + suffix, broken, (version,), True))
    _check_clashes(columns)
    return columns


def _check_clashes(columns: list[EntityColumn]) -> None:
    owners: dict[str, set[tuple[str, str]]] = defaultdict(set)
    for c in columns:
        owners[c.column].add((c.vendor, c.name))
    for column, pairs in sorted(owners.items()):
        if len(pairs) > 1:
            listed = " and ".join(f"{vendor}/{name}" for vendor, name in sorted(pairs))
            raise ClashingSchemas(f"column {column} is asked for by {listed}; skip all but one")
