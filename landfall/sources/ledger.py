"""The type ledger: what type each entity column landed with, and how it has grown since.

A registry may get an older version after a newer one has landed. Planning from the registry alone would
then give one column another type in later batches. The ledger is a table beside the batch log that holds
every type a column was planned with; each plan starts from there and may only add to it, and versions that
don't fit get recovery columns. It is written only when a column is new or grows, before the batch's
files, so it has one row for each change of a column however many batches there are.

Claims are folded in the order of their number; a claim that doesn't fit those before it counts for
nothing, and whoever made it sees that and plans again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.plans.columns import EntityColumn
from landfall.plans.field_types import TypeConflict, merge_types

Entity = tuple[str, str, str, int]

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("model", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("claim", T.StringType()),
    ]
)


def _text(kind: T.DataType) -> str:
    return T.StructType([T.StructField("type", kind)]).json()


def _kind(text: str) -> T.DataType:
    return T.StructType.fromJson(json.loads(text)).fields[0].dataType


def fold(claims: Iterable[tuple[int, str, str]]) -> T.DataType | None:
    """The type after (number, claim, type) rows of one column."""
    merged: T.DataType | None = None
    for _, _, text in sorted(claims):
        try:
            merged = _kind(text) if merged is None else merge_types(merged, _kind(text))
        except TypeConflict:
            continue
    return merged


class TypeLedger:
    """Types known so far are kept, so a batch without new columns reads and writes nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._types: dict[Entity, T.DataType] = {}
        self._number = 0

    def types(self, entities: Iterable[Entity]) -> dict[Entity, T.DataType]:
        """Types of those of the entities that have landed before."""
        wanted = set(entities)
        if wanted - set(self._types):
            self._read(wanted)
        return {e: self._types[e] for e in wanted if e in self._types}

    def claim(self, columns: Iterable[EntityColumn]) -> dict[Entity, T.DataType]:
        """Records the types of columns that are new or have grown; returns what holds afterwards."""
        planned = {(c.kind, c.vendor, c.name, c.model): c.data_type for c in columns if not c.recovered}
        changed = {e: kind for e, kind in planned.items() if self._types.get(e) != kind}
        if changed:
            rows = [(*e, _text(kind), self._number + 1, uuid4().hex) for e, kind in sorted(changed.items(), key=lambda x: x[0])]
            self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self._read(set(changed))
        return {e: self._types[e] for e in planned}

    def _read(self, entities: set[Entity]) -> None:
        try:
            ledger = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return
            raise
        claims: dict[Entity, list] = {}
        for row in ledger.where(F.col("name").isin(sorted({e[2] for e in entities}))).collect():
            entity = (row["kind"], row["vendor"], row["name"], row["model"])
            claims.setdefault(entity, []).append((row["number"], row["claim"], row["type"]))
            self._number = max(self._number, row["number"])
        self._types |= {e: fold(rows) for e, rows in claims.items()}
