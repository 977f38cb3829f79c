"""The fixed part of an event line, as data: ordered names, types, required or not.

The layout is a plain ``StructType``. ``NOT NULL`` marks a required field and
``VARIANT`` marks a field that holds JSON text. The field named ``unstruct`` holds
one self-describing item; fields named in ``contexts`` hold a list of them. Those
fields feed the entity columns and are left out of the fixed output columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    schema: T.StructType
    unstruct: str | None = "unstruct_event"
    contexts: tuple[str, ...] = ("contexts",)
    # True: the item sits in the ``data`` of an outer {"schema", "data"} object.
    envelope: bool = True
    event_time: str = "collector_tstamp"
    load_time: str = "etl_tstamp"

    def __post_init__(self):
        names = self.schema.fieldNames()
        if len({n.lower() for n in names}) != len(names):
            raise ValueError(f"layout has repeated field names: {names}")
        for name in self.entity_fields:
            if name not in names or not isinstance(self.schema[name].dataType, T.VariantType):
                raise ValueError(f"layout field {name} must exist and be VARIANT")
        for f in self.fixed:
            if isinstance(f.dataType, T.VariantType):
                raise ValueError(f"layout field {f.name} is VARIANT but no entity field")
        if self.event_time not in names:
            raise ValueError(f"layout has no event time field {self.event_time}")

    @classmethod
    def from_ddl(cls, ddl: str, **kwargs) -> Layout:
        """Build a layout from ``"event_id STRING NOT NULL, contexts VARIANT, ..."``."""
        return cls(T.StructType.fromDDL(ddl), **kwargs)

    @property
    def entity_fields(self) -> list[str]:
        return [*([] if self.unstruct is None else [self.unstruct]), *self.contexts]

    @property
    def fixed(self) -> list[T.StructField]:
        """Output fields that do not depend on the batch, in line order."""
        return [f for f in self.schema.fields if f.name not in self.entity_fields]

    @property
    def base_schema(self) -> T.StructType:
        """Schema of the landed fixed columns."""
        return T.StructType(self.fixed)


def _field(name: str, kind: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, not required)


# A small default; deployments pass the full field list of their own pipeline.
DEFAULT_LAYOUT = Layout(
    T.StructType(
        [
            _field("event_id", T.StringType(), required=True),
            _field("collector_tstamp", T.TimestampType(), required=True),
            _field("etl_tstamp", T.TimestampType()),
            _field("dvce_created_tstamp", T.TimestampType()),
            _field("derived_tstamp", T.TimestampType()),
            _field("true_tstamp", T.TimestampType()),
            _field("event_name", T.StringType()),
            _field("unstruct_event", T.VariantType()),
            _field("contexts", T.VariantType()),
            _field("derived_contexts", T.VariantType()),
        ]
    ),
    contexts=("contexts", "derived_contexts"),
)
