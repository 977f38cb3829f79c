"""Text to typed values; NULL where the text does not fit. Independent of session time zone."""

from __future__ import annotations

from pyspark.sql import types as T


def text_to_timestamp(text: str) -> str:
    """ISO or space-separated date and time; text without a zone is taken as UTC.

    Digits below the millisecond are dropped.
    """
    # Without the dash in place the cast would read a bare time of day as today's.
    dated = f"CASE WHEN substr({text}, 5, 1) = '-' THEN {text} END"
    instant = (
        f"coalesce(try_cast({dated} || 'Z' AS TIMESTAMP), try_cast({dated} AS TIMESTAMP))"
    )
    return f"timestamp_millis(unix_millis({instant}))"


def text_to_date(text: str) -> str:
    return f"try_cast(CASE WHEN length({text}) = 10 THEN {text} END AS DATE)"


def text_to_type(text: str, kind: T.DataType) -> str:
    """SQL of the typed value of a text expression."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampType):
        return text_to_timestamp(text)
    if isinstance(kind, T.DateType):
        return text_to_date(text)
    return f"try_cast({text} AS {kind.simpleString()})"
