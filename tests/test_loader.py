"""The whole load on small inputs: what lands, what fails, what is counted, in which order."""

from __future__ import annotations

import re
from datetime import UTC, datetime

import events
import pytest
from pyspark.sql import functions as F

from landfall.options import LoadOptions, Processor
from landfall.plans.columns import ClashingSchemas
from landfall.sources import landing as landing_module
from landfall.sources.failed import read_failed, send_failed, write_failed
from landfall.sources.landing import read_landing
from landfall.sources.manifest import Manifest, batch_log, logged_schema, read_committed
from landfall.streaming import loader as loader_module
from landfall.streaming.loader import Loader, MissingSchemas

OWN = "unstruct_event_shop"
LIST = "contexts_shop"
ORDER, ORDER_SHIPPED = "shop/order/jsonschema/2-0-0", "shop/order/jsonschema/2-1-3"
REFUND, REFUND_SPLIT = "shop/refund/jsonschema/3-0-0", "shop/refund/jsonschema/3-2-0"
HEARTBEAT, DUMP = "shop/heartbeat/jsonschema/1-0-4", "shop/debugDump/jsonschema/5-1-0"
TO_BERN = {"number": "B-2", "total": 9, "ship_to": {"city": "Bern", "zip": "3000"}}


@pytest.fixture
def load(spark, tmp_path):
    """Load texts as one batch; returns the result and the landed rows, if any."""

    def run(*texts, batch_id=0, schemas=events.SCHEMAS, **changes):
        options = LoadOptions(
            str(tmp_path / "landing"),
            str(tmp_path / "failed"),
            str(tmp_path / "log"),
            layout=events.layout(),
            processor=Processor("test", "0"),
            **changes,
        )
        loader = Loader(options, events.registry(spark, schemas))
        result = loader.process(events.lines(spark, *texts), batch_id)
        landed = read_committed(spark, options.manifest, options.landing) if result.good else None
        run.options, run.loader = options, loader
        return result, landed

    return run


def values(landed, *columns) -> set:
    return {tuple(r) for r in landed.select(*columns).collect()}


def test_no_input_lands_one_empty_file(spark, tmp_path):
    options = LoadOptions(str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"))
    loader = Loader(options, events.registry(spark))
    loader.seed(datetime(2024, 5, 1, 3, tzinfo=UTC))
    seeded = spark.read.parquet(options.landing)
    assert seeded.count() == 0
    assert seeded.drop("load_tstamp_date", "load_batch").schema.fieldNames() == [
        f.name for f in options.layout.fixed
    ]
    assert len(list((tmp_path / "l" / "load_tstamp_date=2024-05-01").rglob("*.parquet"))) == 1


def test_good_rows_land_with_counts(spark, load):
    result, landed = load(*[events.line(i) for i in "abcd"])
    assert (result.good, result.bad) == (4, 0)
    assert landed.count() == 4 and landed.where("etl_tstamp IS NOT NULL").count() == 0
    (row,) = batch_log(spark, load.options.manifest).collect()
    assert (row["good"], row["bad"], row["attempt"]) == (4, 0, 0)
    assert result.earliest == datetime.fromisoformat(events.TIME).replace(tzinfo=UTC)
    assert landed.columns == [f.name for f in load.options.layout.fixed]


def test_only_bad_rows_write_no_data_but_are_counted(spark, load, tmp_path):
    result, _ = load(*["nonsense1", "nonsense2"] * 3)
    assert (result.good, result.bad, result.earliest) == (0, 6, None)
    assert not (tmp_path / "landing").exists()
    assert read_failed(spark, load.options.failed).count() == 6
    (row,) = batch_log(spark, load.options.manifest).collect()
    assert (row["good"], row["bad"], row["earliest"]) == (0, 6, None)


def test_mixed_rows_are_separated(spark, load):
    result, landed = load(*["nonsense1", "nonsense2"] * 3, *[events.line(i) for i in "abcdef"])
    assert (result.good, result.bad) == (6, 6) and landed.count() == 6
    failed = read_failed(spark, load.options.failed).collect()
    assert {(r["processor_name"], r["payload"]) for r in failed} == {
        ("test", "nonsense1"),
        ("test", "nonsense2"),
    }


def test_empty_batch(load, tmp_path):
    result, _ = load()
    assert (result.good, result.bad) == (0, 0)
    assert not (tmp_path / "landing").exists() and not (tmp_path / "failed").exists()


def test_orders_of_both_versions_share_an_event_column(load):
    _, landed = load(
        events.line("plain", events.own(ORDER, {"number": "B-1"})),
        events.line("shipped", events.own(ORDER_SHIPPED, TO_BERN)),
        events.line("other"),
    )
    order = f"{OWN}_order_2"
    assert [c for c in landed.columns if c.startswith((OWN, LIST))] == [order]
    found = values(landed, "event_id", f"{order}.number", f"{order}.total", f"{order}.ship_to.city")
    assert found == {("plain", "B-1", None, None), ("shipped", "B-2", 9, "Bern"), ("other", None, None, None)}


def test_items_of_two_list_fields_share_a_column_and_keep_their_version(load):
    refund = (REFUND, {"cents": 5})
    _, landed = load(
        events.line("two", "", events.listed((ORDER, {"number": "B-1"}), refund), events.listed((ORDER_SHIPPED, TO_BERN))),
        events.line("none"),
    )
    found = {r["event_id"]: r[f"{LIST}_order_2"] for r in landed.collect()}
    assert found["none"] is None
    assert [(x["_schema_version"], x["number"], x["total"]) for x in found["two"]] == [
        ("2-0-0", "B-1", None),
        ("2-1-3", "B-2", 9),
    ]
    assert found["two"][1]["ship_to"]["zip"] == "3000"


@pytest.mark.parametrize("place", ["event", "contexts"])
def test_a_number_that_became_an_object_gets_a_recovery_column(load, place):
    old, new = {"cents": 70, "reason": "late"}, {"cents": {"net": 60, "tax": 10}}
    if place == "event":
        texts = [events.line("old", events.own(REFUND, old)), events.line("new", events.own(REFUND_SPLIT, new))]
    else:
        texts = [events.line("both", "", events.listed((REFUND_SPLIT, new), (REFUND, old)))]
    result, landed = load(*texts)
    main, recovered = [c.column for c in result.columns]
    assert recovered.startswith(f"{main}_recovered_3_2_0_")
    if place == "event":
        found = values(landed, "event_id", f"{main}.cents", f"{recovered}.cents.tax")
        assert found == {("old", 70, None), ("new", None, 10)}
    else:
        row = landed.first()
        assert [(x["_schema_version"], x["cents"], x["reason"]) for x in row[main]] == [("3-0-0", 70, "late")]
        assert [(x["_schema_version"], x["cents"]["net"]) for x in row[recovered]] == [("3-2-0", 60)]


def test_a_schema_that_allows_nothing_has_no_column(load):
    texts = [
        events.line("own", events.own(HEARTBEAT, {})),
        events.line("listed", "", events.listed((HEARTBEAT, {}), (HEARTBEAT, {}))),
    ]
    result, landed = load(*texts)
    assert (result.good, result.columns) == (2, ())
    assert not [c for c in landed.columns if c.startswith((OWN, LIST))]


def test_a_schema_without_fields_lands_as_text_in_order(load):
    first, second = events.listed((DUMP, {"heap": [3, {"mb": 4}]}), (ORDER, {"number": "B-1"})), events.listed((DUMP, {}))
    _, landed = load(events.line("a", events.own(DUMP, {"trace": "x", "at": {"line": 1}}), first, second))
    row = landed.select(f"{OWN}_debug_dump_5", f"{LIST}_debug_dump_5").first()
    assert row[0] == '{"trace":"x","at":{"line":1}}'
    assert row[1] == ['{"_schema_version":"5-1-0","heap":[3,{"mb":4}]}', '{"_schema_version":"5-1-0"}']


UNKNOWN = events.own("shop/parcel/jsonschema/4-0-1", {"weight": 2})


def test_missing_schema_stops_when_strict(load, tmp_path):
    with pytest.raises(MissingSchemas, match="no registered schema.*shop/parcel/jsonschema/4-0-1"):
        load(events.line("a", UNKNOWN), events.line("b"))
    assert not (tmp_path / "landing").exists()


def test_missing_schema_fails_its_events_when_lenient(spark, load):
    later = events.listed(("shop/order/jsonschema/2-9-0", {"number": "B-9"}), (ORDER, {"number": "B-1"}))
    result, _ = load(events.line("a", UNKNOWN), events.line("b", "", later), events.line("c"), strict=False)
    assert (result.good, result.bad) == (1, 2)
    failed = read_failed(spark, load.options.failed).collect()
    assert {r["failure"] for r in failed} == {
        "schema not found: shop/parcel/jsonschema/4-0-1",
        "schema not found: shop/order/jsonschema/2-9-0",
    }


def test_two_spellings_of_a_name_stop_even_when_lenient(load):
    items = [
        ("shop/cartItem/jsonschema/2-0-0", {"sku": "s", "price": 1.5}),
        ("shop/cart_item/jsonschema/2-1-0", {"line": {"sku": "s"}}),
    ]
    with pytest.raises(ClashingSchemas, match="contexts_shop_cart_item_2 is asked for by"):
        load(events.line("a", "", events.listed(*items)), strict=False)


def test_skipped_schemas_get_no_column_and_need_no_registration(load):
    result, landed = load(
        events.line("a", UNKNOWN),
        events.line("b", events.own(REFUND, {"cents": "not a number"})),
        events.line("c", events.own(REFUND_SPLIT, {"cents": {"net": 1}})),
        skip_schemas=("sd:shop/parcel/jsonschema/*-*-*", "sd:shop/refund/jsonschema/3-0-0"),
    )
    assert (result.good, result.bad) == (3, 0)
    main, recovered = [c.column for c in result.columns]
    assert landed.where(F.col(main).isNotNull()).isEmpty()
    assert landed.where(F.col(recovered).isNotNull()).count() == 1


def test_lenient_load_does_not_fail_skipped_schemas(load):
    gone = events.own("shop/voucher/jsonschema/1-1-1", {})
    skipped = ("sd:shop/parcel/jsonschema/4-*-*",)
    result, _ = load(events.line("a", UNKNOWN), events.line("b", gone), skip_schemas=skipped, strict=False)
    assert (result.good, result.bad) == (1, 1)


def test_value_of_the_wrong_type_fails_the_event_but_counts_as_parsed(spark, load):
    early = events.line("a", events.own(ORDER, {"number": 17}), tstamp="2019-07-08 09:10:11")
    result, _ = load(early, events.line("b"), "nonsense")
    assert (result.good, result.bad) == (1, 2)
    assert result.earliest == datetime(2019, 7, 8, 9, 10, 11, tzinfo=UTC)
    failures = {r["failure"] for r in read_failed(spark, load.options.failed).collect()}
    assert f"{OWN}_order_2.number: expected string" in failures


def test_size_cap_on_failed_events(spark, load):
    load("short", "long" * 100, failed_max_bytes=300)
    failed = {r["payload"]: r["failure"] for r in read_failed(spark, load.options.failed).collect()}
    assert failed["short"] == "expected 7 fields, found 1"
    assert failed[("long" * 100)[:30]].startswith("size violation: ")


def test_failed_events_to_another_sink(spark, load, tmp_path):
    out = str(tmp_path / "sink")
    for texts in ((events.line("a"),), ("nonsense",)):
        load(*texts, failed_format="parquet", failed_options={"path": out}, batch_id=len(texts[0]))
    assert spark.read.parquet(out).count() == 1


def test_load_time_override_is_one_value(load):
    texts = [events.line(i, etl="2001-01-01 00:00:00") for i in "ab"]
    _, landed = load(*texts, override_load_time=True)
    times = values(landed, F.unix_millis("etl_tstamp"))
    assert len(times) == 1 and times.pop()[0] > 1_600_000_000_000


def test_batch_is_not_loaded_twice(load):
    first, _ = load(events.line("a"))
    again = load.loader.process(events.lines(load.loader.registry.sparkSession, events.line("a")), 0)
    assert (first.good, again.repeated) == (1, True)
    assert read_landing(load.loader.registry.sparkSession, load.options.landing).count() == 1


def test_retry_after_a_crash_replaces_what_was_written(spark, load, monkeypatch):
    """The first try lands its rows and dies before it is recorded as done."""

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "commit", crash)
        with pytest.raises(RuntimeError, match="lost"):
            load(events.line("a"), "nonsense")
    result, landed = load(events.line("a"), "nonsense")
    assert (result.good, landed.count()) == (1, 1)
    assert read_failed(spark, load.options.failed).count() == 1
    assert [r["attempt"] for r in batch_log(spark, load.options.manifest).collect()] == [1]


def test_failed_events_go_out_before_good_rows(load, monkeypatch):
    order = []
    for name in ("write_failed", "write_batch"):
        original = getattr(loader_module, name)

        def spy(*args, _name=name, _original=original, **kwargs):
            order.append(_name)
            return _original(*args, **kwargs)

        monkeypatch.setattr(loader_module, name, spy)
    load(events.line("a"), "nonsense")
    assert order == ["write_failed", "write_batch"]


def test_columns_evolve_from_batch_to_batch(load):
    load(events.line("a", events.own(ORDER, {"number": "B-1"})))
    _, landed = load(
        events.line("b", events.own(ORDER_SHIPPED, TO_BERN)),
        events.line("c", "", events.listed((REFUND, {"cents": 5}))),
        batch_id=1,
    )
    city = values(landed, "event_id", f"{OWN}_order_2.ship_to.city")
    assert city == {("a", None), ("b", "Bern"), ("c", None)}
    assert landed.where(f"{LIST}_refund_3 IS NOT NULL").count() == 1
    options, spark = load.options, landed.sparkSession
    logged = logged_schema(spark, options.manifest, options.layout)
    assert set(logged.fieldNames()) == set(landed.columns)
    quick = read_landing(spark, options.landing, schema=logged).select(landed.columns)
    assert {str(r) for r in quick.collect()} == {str(r) for r in landed.collect()}


def test_uncached_load_gives_the_same(load):
    result, landed = load(events.line("a"), "nonsense", cache=False)
    assert (result.good, result.bad, landed.count()) == (1, 1, 1)


def test_duplicate_registry_rows_do_not_change_counts(spark, tmp_path):
    options = LoadOptions(
        str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout()
    )
    twice = events.registry(spark).union(events.registry(spark))
    text = events.line("a", events.own(ORDER, {"number": "B-1"}))
    assert Loader(options, twice).process(events.lines(spark, text), 0).good == 1


def test_files_of_a_batch():
    count = landing_module.file_count
    target = 128 * 1024 * 1024
    assert count(0, target, 8) == 1 and count(15_000_000, target, 8) == 1
    assert count(40_000_000, target, 8) == 3 and count(10**9, target, 8) == 8
    assert count(10**13, target, 8) == 74506


def test_stream_resumes_and_equals_a_batch(spark, tmp_path, load):
    texts = [events.line(str(i)) for i in range(20)] + ["nonsense"]
    _, batch = load(*texts)
    options = LoadOptions(
        str(tmp_path / "sl"), str(tmp_path / "sf"), str(tmp_path / "sm"), layout=events.layout()
    )
    source, checkpoint = str(tmp_path / "source"), str(tmp_path / "checkpoint")
    loader = Loader(options, events.registry(spark), "stream")
    for part in (texts[:10], texts[10:], []):
        if part:
            events.lines(spark, *part).write.mode("append").text(source)
        stream = spark.readStream.text(source)
        loader.run(stream, checkpoint).awaitTermination()
    streamed = read_landing(spark, options.landing)
    assert values(streamed, "event_id") == values(batch, "event_id")
    assert streamed.count() == 20
    log = batch_log(spark, options.manifest)
    assert {(r["good"], r["bad"]) for r in log.collect()} == {(10, 0), (10, 1)}


def test_retry_after_registration_lands_what_had_failed(load, monkeypatch):
    text = events.line("a", events.own(ORDER, {"number": "B-1"}))

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "commit", crash)
        with pytest.raises(RuntimeError, match="lost"):
            load(text, schemas={}, strict=False)
    result, landed = load(text, strict=False)
    assert (result.good, result.bad, landed.count()) == (1, 0, 1)
    assert read_failed(landed.sparkSession, load.options.failed).count() == 0


@pytest.mark.parametrize("name", ["eu#1", "eu=1", "eu:1", "eu/1", "eu 1", "50%"])
def test_any_name_of_a_load(spark, tmp_path, name):
    options = LoadOptions(
        str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout()
    )
    loader = Loader(options, events.registry(spark), name)
    result = loader.process(events.lines(spark, events.line("1"), "nonsense"), 0)
    assert (result.good, result.bad) == (1, 1)
    assert values(read_landing(spark, options.landing), "event_id") == {("1",)}
    assert read_failed(spark, options.failed).count() == 1
    assert loader.process(events.lines(spark, events.line("1"), "nonsense"), 0).repeated


def test_stream_backlog_and_new_checkpoint_are_apart(spark, tmp_path):
    options = LoadOptions(
        str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout()
    )
    loader = Loader(options, events.registry(spark))
    source = str(tmp_path / "source")
    events.lines(spark, events.line("streamed")).write.text(source)
    loader.run(spark.readStream.text(source), str(tmp_path / "one")).awaitTermination()
    assert loader.process(events.lines(spark, events.line("backlog")), 0).good == 1
    loader.run(spark.readStream.text(source), str(tmp_path / "two")).awaitTermination()
    landed = read_landing(spark, options.landing)
    assert sorted(r["event_id"] for r in landed.collect()) == ["backlog", "streamed", "streamed"]


def test_all_missing_schemas_are_listed(spark, load):
    texts = [events.line(str(i), events.own(f"test/none{i}/jsonschema/1-0-0", {})) for i in range(130)]
    with pytest.raises(loader_module.MissingSchemas, match="130 schema versions") as error:
        load(*texts)
    folder = re.search(r"items in (\S+)\. ", str(error.value))[1]
    assert spark.read.parquet(folder).count() == 130


def test_a_null_line_fails(load, spark):
    result, landed = load(events.line("a"), None)
    assert (result.good, result.bad) == (1, 1)


def jobs_of(spark, group, run) -> int:
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setJobGroup("rest", "rest")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_of_a_batch(spark, tmp_path):
    """The writes count what they write, and a known model needs no second look at the registry."""
    options = LoadOptions(str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout())
    loader = Loader(options, events.registry(spark))
    lines = events.lines(spark, events.line("a", events.own(ORDER, {"number": "B-1"})), "nonsense").repartition(8).cache()
    first = jobs_of(spark, "first-batch", lambda: loader.process(lines, 0))
    second = jobs_of(spark, "second-batch", lambda: loader.process(lines, 1))
    assert second <= 12 and second < first, (first, second)
    assert [r["bad"] for r in batch_log(spark, options.manifest).collect()] == [1, 1]


def test_a_version_registered_later_is_found(spark, load, tmp_path):
    """The texts of a model are read again for a version that is not among them."""
    both = {name: events.SCHEMAS[name] for name in ("shop/order/2-0-0", "shop/order/2-1-3")}
    events.registry(spark, {"shop/order/2-0-0": both["shop/order/2-0-0"]}).write.parquet(str(tmp_path / "registry"))
    registry = spark.read.parquet(str(tmp_path / "registry"))
    options = LoadOptions(str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout())
    loader = Loader(options, registry)
    loader.process(events.lines(spark, events.line("a", events.own(ORDER, {"number": "B-1"}))), 0)
    events.registry(spark, {"shop/order/2-1-3": both["shop/order/2-1-3"]}).write.mode("append").parquet(str(tmp_path / "registry"))
    spark.catalog.refreshByPath(str(tmp_path / "registry"))
    loader.registry = loader.known.registry = spark.read.parquet(str(tmp_path / "registry"))
    result = loader.process(events.lines(spark, events.line("b", events.own(ORDER_SHIPPED, TO_BERN))), 1)
    assert (result.good, result.bad) == (1, 0)
    assert sorted(loader.known.of([])) == []
    landed = read_committed(spark, options.manifest, options.landing)
    assert {r["n"] for r in landed.select(F.col(f"{OWN}_order_2.number").alias("n")).collect()} == {"B-1", "B-2"}


def test_failed_rows_are_counted_by_their_write(spark, tmp_path):
    texts = spark.createDataFrame([(str(i),) for i in range(100)], "value string").repartition(5)
    assert write_failed(texts, str(tmp_path / "a"), "x") == 100
    assert write_failed(texts.where("false"), str(tmp_path / "a"), "x") == 0
    assert send_failed(spark.createDataFrame([], "value string"), "parquet", {"path": str(tmp_path / "b")}) == 0
    assert send_failed(texts.limit(7), "parquet", {"path": str(tmp_path / "b")}) == 7
