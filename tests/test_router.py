"""Items find their columns by one look-up each, however many columns a batch has."""

from __future__ import annotations

import random
import re

import events

from landfall.operators.parse import FAILURE, parse_lines
from landfall.operators.project import assemble, transform_events
from landfall.plans.columns import SeenVersion, plan_columns

MANY = 200
NAMES = [f"s{i}" for i in range(MANY)]
PLAIN = events.object_schema({"a": {"type": "integer"}})
TEXT_KEPT = '{"type": "object"}'


def planned(names=NAMES, kinds=("unstruct", "contexts")):
    schemas = {("many", n, 1): {(0, 0): PLAIN if int(n[1:]) % 3 else TEXT_KEPT} for n in names}
    return plan_columns([SeenVersion(k, "many", n, 1, 0, 0) for n in names for k in kinds], schemas)


def transformed(spark, texts, columns):
    parsed = parse_lines(events.lines(spark, *texts), events.layout())
    return transform_events(parsed, events.layout(), columns)


def schema(name):
    return f"many/{name}/jsonschema/1-0-0"


def test_every_item_lands_in_its_own_column(spark):
    draw = random.Random(11)
    texts, wanted = [], {}
    for i in range(120):
        own = draw.choice([*NAMES[:40], "unplanned"])
        lists = [[(draw.choice([*NAMES[:12], "unplanned"]), draw.randrange(99)) for _ in range(draw.randrange(5))] for _ in range(2)]
        cells = [events.listed(*[(schema(n), {"a": v}) for n, v in part]) if part else "" for part in lists]
        texts.append(events.line(str(i), events.own(schema(own), {"a": i}), *cells))
        found = {}
        for name, value in [x for part in lists for x in part]:
            found.setdefault(f"contexts_many_{name}_1", []).append(value)
        found[f"unstruct_event_many_{own}_1"] = i
        wanted[str(i)] = {k: v for k, v in found.items() if "unplanned" not in k}
    columns = planned()
    landed = assemble(transformed(spark, texts, columns), events.layout(), columns)

    def value(cell):
        if isinstance(cell, str):
            return int(re.search(r'"a":(\d+)', cell)[1])
        return cell["a"]

    for row in landed.collect():
        got = {}
        for c in columns:
            cell = row[c.column]
            if cell is not None:
                got[c.column] = [value(x) for x in cell] if isinstance(cell, list) else value(cell)
        assert got == wanted[row["event_id"]]


def test_an_item_that_does_not_fit_fails_its_row_alone(spark):
    columns = planned()
    good = events.listed((schema("s1"), {"a": 1}), (schema("s2"), {"a": 2}))
    broken = events.listed((schema("s1"), {"a": 1}), (schema("s2"), {"a": "x"}))
    rows = transformed(spark, [events.line("g", "", good), events.line("b", "", broken), "nonsense"], columns)
    failures = {r["event_id"]: r[FAILURE] for r in rows.collect()}
    assert failures["g"] is None and "contexts_many_s2_1" in failures["b"]
    assert sum(f is not None for f in failures.values()) == 2


def expressions(spark, names) -> str:
    frame = transformed(spark, ["x"], planned(names))
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_read_once_per_item_not_per_column(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        few, many = expressions(spark, NAMES[:4]), expressions(spark, NAMES)
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    keys = re.compile(r"substring_index\([^()]*, :, -1\)")
    assert len(keys.findall(many)) == len(keys.findall(few)) == 2
    # one look-up by number for each further column (it stands in a condition and in its branch)
    assert many.count("_by_column") <= few.count("_by_column") + 2 * (MANY - 4) + 2


def test_columns_of_one_kind_only(spark):
    for kinds in (("unstruct",), ("contexts",)):
        columns = planned(NAMES[:3], kinds)
        both = events.line("a", events.own(schema("s1"), {"a": 1}), events.listed((schema("s2"), {"a": 2})))
        row = assemble(transformed(spark, [both], columns), events.layout(), columns).first()
        assert [c for c in row.asDict() if row[c] is not None and "many" in c] == [
            "unstruct_event_many_s1_1" if kinds == ("unstruct",) else "contexts_many_s2_1"
        ]
