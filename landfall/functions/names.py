"""Column names derived from schema and field names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed rule, in order: split camelCase humps, then replace what is not a word character.
_RULES = (
    (r"([a-z0-9])([A-Z])", "$1_$2"),
    (r"([A-Z]+)([A-Z][a-z])", "$1_$2"),
    (r"[^A-Za-z0-9_]", "_"),
)

UNSTRUCT = "unstruct"
CONTEXTS = "contexts"
_PREFIX = {UNSTRUCT: "unstruct_event", CONTEXTS: "contexts"}


def normalize_name(name: str) -> str:
    """``acme.userId`` → ``acme_user_id``."""
    for pattern, replacement in _RULES:
        name = re.sub(pattern, replacement.replace("$", "\\"), name)
    return name.lower()


def normalized(name: Column) -> Column:
    """The same rule over a column of names."""
    for pattern, replacement in _RULES:
        name = F.regexp_replace(name, pattern, replacement)
    return F.lower(name)


def column_name(kind: str, vendor: str, name: str, model: int) -> str:
    return f"{_PREFIX[kind]}_{normalize_name(vendor)}_{normalize_name(name)}_{model}"


def entity_column_name(kind: Column, vendor: Column, name: Column, model: Column) -> Column:
    """:func:`column_name` over columns."""
    prefix = F.when(kind == UNSTRUCT, _PREFIX[UNSTRUCT]).otherwise(_PREFIX[CONTEXTS])
    return F.concat_ws("_", prefix, normalized(vendor), normalized(name), model.cast("string"))
