"""Schema references, ``scheme:vendor/name/jsonschema/model-revision-addition``.

The key of a reference is its text without the scheme. Rows are compared by key, as
plain strings; keys are taken apart only where they are few, after aggregation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions import sql

# The parts of a reference.
FORMAT = "jsonschema"
_NAME = r"[A-Za-z0-9_.\-]+"
_NUMBER = r"(?:0|[1-9][0-9]*)"
_SCHEME = r"(?:[a-z]+:)?"
_REFERENCE = rf"^{_SCHEME}{_NAME}/{_NAME}/{FORMAT}/[1-9][0-9]*-{_NUMBER}-{_NUMBER}$"
_CRITERION = re.compile(
    rf"^{_SCHEME}({_NAME})/({_NAME})/{FORMAT}/([1-9][0-9]*|\*)-({_NUMBER}|\*)-({_NUMBER}|\*)$"
)

REF_FIELDS = ("vendor", "name", "model", "revision", "addition")


def is_reference(uri: str) -> str:
    """SQL condition; NULL for a NULL text."""
    return f"{uri} RLIKE {sql.text(_REFERENCE)}"


def key_of(uri: str) -> str:
    return f"substring_index({uri}, ':', -1)"


def version_of(uri: str) -> str:
    """``model-revision-addition`` of a reference."""
    return f"substring_index({uri}, '/', -1)"


def key_text(vendor: str, name: str, model: int, revision: int, addition: int) -> str:
    return f"{vendor}/{name}/{FORMAT}/{model}-{revision}-{addition}"


def key_parts(key: str) -> list[Column]:
    """The columns ``vendor, name, model, revision, addition`` of a key."""
    parts = f"split({key}, '/')"
    numbers = f"split(get({parts}, 3), '-')"
    texts = [f"get({parts}, {i}) AS {part}" for i, part in enumerate(REF_FIELDS[:2])]
    numeric = [
        f"try_cast(get({numbers}, {i}) AS INT) AS {part}" for i, part in enumerate(REF_FIELDS[2:])
    ]
    return [F.expr(e) for e in (*texts, *numeric)]


@dataclass(frozen=True)
class Criterion:
    """A schema reference whose version parts may be ``*``; None stands for ``*``."""

    vendor: str
    name: str
    model: int | None
    revision: int | None
    addition: int | None

    @classmethod
    def parse(cls, text: str) -> Criterion:
        match = _CRITERION.match(text)
        if not match:
            raise ValueError(f"not a schema criterion: {text}")
        numbers = [None if p == "*" else int(p) for p in match.groups()[2:]]
        return cls(match[1], match[2], *numbers)

    @property
    def pattern(self) -> str:
        """Regular expression of the keys it matches."""
        names = f"{re.escape(self.vendor)}/{re.escape(self.name)}/{FORMAT}/"
        numbers = (self.model, self.revision, self.addition)
        return names + "-".join("[0-9]+" if n is None else str(n) for n in numbers)


def matches_any(criteria: list[Criterion], key: str) -> str:
    """SQL condition whether a key is on the list; never NULL."""
    if not criteria:
        return "false"
    pattern = "^(?:" + "|".join(c.pattern for c in criteria) + ")$"
    return f"coalesce({key} RLIKE {sql.text(pattern)}, false)"
