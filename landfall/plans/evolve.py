"""Versions of one schema model: a merged column, and recovery columns for breaks."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

from pyspark.sql import types as T

from landfall.plans.field_types import TypeConflict, merge_types, planned_type

SubVersion = tuple[int, int]


@dataclass(frozen=True)
class Evolution:
    """``merged`` is None when no version has a column; ``recovered`` maps break → type."""

    merged: T.DataType | None
    recovered: dict[SubVersion, T.DataType] = field(default_factory=dict)


def _optional(kind: T.DataType) -> T.DataType:
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in kind.fields])


def merge_versions(schemas: dict[SubVersion, str], landed: T.DataType | None = None) -> Evolution:
    """Merge in (revision, addition) order; a version that conflicts leaves the merge.

    ``landed`` is the type the column has in earlier batches. The merge goes on from it, so
    it keeps all of its fields, and a version that conflicts with it leaves the merge even
    if it is older than those that landed.
    """
    merged = landed
    recovered: dict[SubVersion, T.DataType] = {}
    saw_empty = False
    for version in sorted(schemas):
        kind = planned_type(schemas[version])
        if kind is None:
            saw_empty = True
        elif merged is None:
            merged = kind
        else:
            try:
                merged = merge_types(merged, kind)
            except TypeConflict:
                recovered[version] = kind
    if merged is not None and saw_empty:
        merged = _optional(merged)
    return Evolution(merged, recovered)


def recovery_suffix(model: int, version: SubVersion, kind: T.DataType) -> str:
    """``_recovered_<model>_<revision>_<addition>_<CRC-32 of the type>``."""
    digest = zlib.crc32(kind.json().encode())
    return f"_recovered_{model}_{version[0]}_{version[1]}_{digest:08x}"
