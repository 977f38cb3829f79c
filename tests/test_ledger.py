"""Column types that outlive the batch, and readers that follow committed tries."""

from __future__ import annotations

import events
import pytest
from pyspark.sql import types as T

from landfall.options import LoadOptions
from landfall.plans.columns import EntityColumn, SeenVersion, plan_columns
from landfall.sources.landing import read_landing
from landfall.sources.ledger import TypeLedger, _text, fold
from landfall.sources.manifest import Manifest, read_committed
from landfall.streaming.loader import Loader

NUMBER, TEXT = {"type": "integer"}, {"type": "string"}
OLD = events.object_schema({"k": NUMBER})
NEW = events.object_schema({"k": TEXT, "n": TEXT}, ["k"])
NEWER = events.object_schema({"k": TEXT, "extra": NUMBER})
KEY = "acme/thing"
COLUMN = "unstruct_event_acme_thing_1"


def options(tmp_path, **changes) -> LoadOptions:
    return LoadOptions(str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout(), **changes)


def thing(name, version, **data) -> str:
    return events.line(name, events.own(f"{KEY}/jsonschema/{version}", data))


def loader(spark, tmp_path, **schemas) -> Loader:
    rows = {f"{KEY}/{v.replace('_', '-').strip('v')}": text for v, text in schemas.items()}
    return Loader(options(tmp_path), events.registry(spark, rows))


def test_an_older_version_registered_late_keeps_the_landed_type(spark, tmp_path):
    first = loader(spark, tmp_path, v1_0_1=NEW).process(events.lines(spark, thing("a", "1-0-1", k="x")), 0)
    # another loader, so what is known of the first comes from the ledger alone
    texts = [thing("b", "1-0-1", k="y", n="z"), thing("c", "1-0-0", k=7)]
    second = loader(spark, tmp_path, v1_0_0=OLD, v1_0_1=NEW).process(events.lines(spark, *texts), 1)
    assert [c.column for c in first.columns] == [COLUMN]
    assert first.columns[0].data_type == second.columns[0].data_type
    assert [c.column for c in second.columns][1].startswith(f"{COLUMN}_recovered_1_0_0_")
    merged = read_landing(spark, options(tmp_path).landing)
    recovered = second.columns[1].column
    found = {tuple(r) for r in merged.select("event_id", f"{COLUMN}.k", f"{recovered}.k").collect()}
    assert found == {("a", "x", None), ("b", "y", None), ("c", None, 7)}


def test_a_column_grows_and_never_shrinks(spark, tmp_path):
    schemas = {"v1_0_1": NEW, "v1_0_2": NEWER}
    wide = loader(spark, tmp_path, **schemas).process(events.lines(spark, thing("a", "1-0-2", k="x", extra=1)), 0)
    narrow = loader(spark, tmp_path, **schemas).process(events.lines(spark, thing("b", "1-0-1", k="y")), 1)
    assert wide.columns[0].data_type == narrow.columns[0].data_type
    assert narrow.columns[0].data_type.fieldNames() == ["k", "n", "extra"]


def test_nothing_is_read_or_written_for_known_columns(spark, tmp_path, monkeypatch):
    one = loader(spark, tmp_path, v1_0_1=NEW)
    one.process(events.lines(spark, thing("a", "1-0-1", k="x")), 0)
    monkeypatch.setattr(TypeLedger, "_read", lambda *_: pytest.fail("the ledger was read"))
    assert one.process(events.lines(spark, thing("b", "1-0-1", k="y")), 1).good == 1
    assert spark.read.parquet(one.ledger.path).count() == 1


def column(kind: T.DataType) -> EntityColumn:
    return EntityColumn("unstruct", "acme", "thing", 1, COLUMN, kind, ((0, 0),))


def test_claims_of_two_loads_agree(spark, tmp_path):
    path = str(tmp_path / "types")
    entity = ("unstruct", "acme", "thing", 1)
    text, number = (T.StructType([T.StructField("k", kind)]) for kind in (T.StringType(), T.LongType()))
    one, two = TypeLedger(spark, path), TypeLedger(spark, path)
    assert one.types([entity]) == two.types([entity]) == {}
    assert one.claim([column(text)]) == {entity: text}
    # the second load planned before it could see the first: both claims have the same number
    held = two.claim([column(number)])[entity]
    assert held == TypeLedger(spark, path).types([entity])[entity]
    assert held in (text, number)
    wider = T.StructType([*held.fields, T.StructField("more", T.DateType())])
    assert two.claim([column(wider)]) == {entity: wider}
    assert TypeLedger(spark, path).types([entity]) == {entity: wider}


def test_a_plan_gives_way_to_an_earlier_claim(spark, tmp_path, monkeypatch):
    """Another load claims the column between this one's look and its own claim."""
    late = loader(spark, tmp_path, v1_0_0=OLD, v1_0_1=NEW)
    other = TypeLedger(spark, late.ledger.path)
    whole = TypeLedger.claim

    def overtaken(self, columns):
        monkeypatch.setattr(TypeLedger, "claim", whole)
        kind = T.StructType([T.StructField("k", T.StringType())])
        other.claim([column(kind)])
        self._number = 1
        return whole(self, columns)

    monkeypatch.setattr(TypeLedger, "claim", overtaken)
    result = late.process(events.lines(spark, thing("a", "1-0-0", k=7), thing("b", "1-0-1", k="x")), 0)
    assert [c.recovered for c in result.columns] == [False, True]
    assert result.columns[0].data_type["k"].dataType == T.StringType()
    assert (result.good, result.bad) == (2, 0)


def test_fold_leaves_out_what_does_not_fit():
    text, number = T.StringType(), T.LongType()
    assert fold([(2, "a", _text(number)), (1, "z", _text(text))]) == text
    assert fold([(1, "b", _text(number)), (1, "a", _text(text))]) == text
    assert fold([]) is None


def test_a_landed_type_leads_the_plan():
    seen = [SeenVersion("unstruct", "acme", "thing", 1, 0, 0), SeenVersion("unstruct", "acme", "thing", 1, 0, 1)]
    schemas = {("acme", "thing", 1): {(0, 0): OLD, (0, 1): NEW}}
    landed = T.StructType([T.StructField("k", T.StringType(), False)])
    main, recovered = plan_columns(seen, schemas, {("unstruct", "acme", "thing", 1): landed})
    assert main.versions == ((0, 1),) and main.data_type.fieldNames() == ["k", "n"]
    assert recovered.versions == ((0, 0),)
    free = plan_columns(seen, schemas)
    assert free[0].versions == ((0, 0),)


def test_a_reader_sees_no_row_twice_and_loses_no_file(spark, tmp_path, monkeypatch):
    """Between a try that was lost, its retry, and the commit."""
    texts = [events.line(str(i)) for i in range(30)]
    load = Loader(options(tmp_path), events.registry(spark))
    made = load.options
    load.process(events.lines(spark, events.line("before")), 0)
    commit, seen = Manifest.commit, []

    def lost(*_, **__):
        raise RuntimeError("lost")

    def looked(*args, **values):
        open_before = read_committed(spark, made.manifest, made.landing)
        seen.append(open_before.count())
        commit(*args, **values)
        seen.append(open_before.count())  # its files are still there

    for act, fails in ((lost, True), (lost, True), (looked, False)):
        monkeypatch.setattr(Manifest, "commit", act)
        if fails:
            with pytest.raises(RuntimeError, match="lost"):
                load.process(events.lines(spark, *texts), 1)
            assert read_committed(spark, made.manifest, made.landing).count() == 1
        else:
            load.process(events.lines(spark, *texts), 1)
    assert seen == [1, 1]
    assert read_committed(spark, made.manifest, made.landing).count() == 31
    assert read_landing(spark, made.landing).count() == 1 + 3 * 30
    days = read_committed(spark, made.manifest, made.landing, partition_columns=True)
    assert {r["load_attempt"] for r in days.collect()} == {0, 2}


def test_no_committed_batch(spark, tmp_path):
    log = Manifest(spark, str(tmp_path / "m"), "x")
    log.start(0)
    assert read_committed(spark, log.path, str(tmp_path / "l")).count() == 0
