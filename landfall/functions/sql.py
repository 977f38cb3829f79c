"""Writing expressions as SQL text.

Expressions that are generated from a plan (one per field of every schema) are written as
SQL text and handed to Spark in one piece: building them from ``Column`` calls costs the
driver several round trips to the JVM per operator, seconds for a batch with many columns.
"""

from __future__ import annotations


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(identifier: str) -> str:
    """A column or field name."""
    return "`" + identifier.replace("`", "``") + "`"


def texts(values: list[str] | tuple[str, ...]) -> str:
    """The inside of an ``IN`` list; an empty list matches nothing."""
    return ", ".join(text(v) for v in values) or "NULL"


def coalesce(parts: list[str]) -> str:
    return f"coalesce({', '.join(parts)})" if parts else "CAST(NULL AS STRING)"


def computed_once(expression: str) -> str:
    """The same value, but a later filter on it stays above its projection.

    The optimizer moves a filter below the projection it reads from by repeating the
    column's expression in it. For the outcome of a whole parse that doubles the work of
    every row. It leaves expressions alone that depend on the partition.
    """
    return f"CASE WHEN spark_partition_id() >= 0 THEN {expression} END"
