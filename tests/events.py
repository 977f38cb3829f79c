"""Lines and schemas for tests, in the shapes the loader is meant to handle."""

from __future__ import annotations

import json

from landfall.layout import Layout

DDL = (
    "event_id STRING NOT NULL, collector_tstamp TIMESTAMP NOT NULL, etl_tstamp TIMESTAMP, "
    "amount DECIMAL(18,2), unstruct_event VARIANT, contexts VARIANT, derived_contexts VARIANT"
)
TIME = "2024-03-05 06:07:08.900"


def layout(**kwargs) -> Layout:
    return Layout.from_ddl(DDL, contexts=("contexts", "derived_contexts"), **kwargs)


def item(schema: str, data) -> dict:
    return {"schema": f"sd:{schema}", "data": data}


def own(schema: str, data) -> str:
    return json.dumps(item("outer/event/jsonschema/1-0-0", item(schema, data)))


def listed(*items: tuple) -> str:
    return json.dumps(item("outer/contexts/jsonschema/1-0-0", [item(s, d) for s, d in items]))


def line(event_id: str, unstruct: str = "", contexts: str = "", derived: str = "", **cells) -> str:
    values = {"tstamp": TIME, "etl": "", "amount": ""} | cells
    return "\t".join(
        [event_id, values["tstamp"], values["etl"], values["amount"], unstruct, contexts, derived]
    )


def lines(spark, *texts: str):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def object_schema(properties: dict, required: list[str] = (), **more) -> str:
    return json.dumps({"type": "object", "properties": properties, "required": list(required)} | more)


TEXT = {"type": "string"}

WHOLE = {"type": "integer", "minimum": 0, "maximum": 1_000_000}

# A shop: orders grow an address, refunds turn their amount from a number into an object.
SCHEMAS = {
    "shop/order/2-0-0": object_schema({"number": TEXT, "total": WHOLE}, ["number"]),
    "shop/order/2-1-3": object_schema(
        {
            "number": TEXT,
            "total": WHOLE,
            "ship_to": {"type": "object", "properties": {"city": TEXT, "zip": TEXT}, "required": ["city"]},
        },
        ["number"],
    ),
    "shop/refund/3-0-0": object_schema({"cents": WHOLE, "reason": TEXT}, ["cents"]),
    "shop/refund/3-2-0": object_schema(
        {"cents": {"type": "object", "properties": {"net": WHOLE, "tax": WHOLE}}, "reason": TEXT}, ["cents"]
    ),
    "shop/heartbeat/1-0-4": json.dumps({"type": "object", "properties": {}, "additionalProperties": False}),
    "shop/debugDump/5-1-0": json.dumps({"type": "object"}),
    # one column name from two spellings, with other fields
    "shop/cartItem/2-0-0": object_schema({"sku": TEXT, "price": {"type": "number"}}, ["sku"]),
    "shop/cart_item/2-1-0": object_schema({"line": {"type": "object", "properties": {"sku": TEXT}}}),
}


def registry(spark, schemas: dict[str, str] = SCHEMAS):
    from landfall.operators.registry import REGISTRY_SCHEMA

    rows = []
    for key, text in schemas.items():
        vendor, name, version = key.split("/")
        rows.append((vendor, name, *[int(n) for n in version.split("-")], text))
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)
