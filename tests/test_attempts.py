"""Logs that loads write themselves: failed tries by their causes, and how long lines waited."""

from __future__ import annotations

import socket
from datetime import UTC, datetime, timedelta

import events
import pytest
from py4j.protocol import Py4JJavaError

from landfall.operators import metrics
from landfall.options import LoadOptions
from landfall.sources.attempts import attempt_log, error_chain, failures_path
from landfall.sources.manifest import received_log
from landfall.streaming import loader as loader_module
from landfall.streaming.loader import Loader

NOON = datetime(2024, 1, 1, 12, tzinfo=UTC)


def options(tmp_path, **changes) -> LoadOptions:
    return LoadOptions(str(tmp_path / "l"), str(tmp_path / "f"), str(tmp_path / "m"), layout=events.layout(), **changes)


def raised(error: BaseException, cause: BaseException | None = None) -> BaseException:
    try:
        raise error from cause
    except type(error) as e:
        return e


def java_error(spark) -> Py4JJavaError:
    with pytest.raises(Py4JJavaError) as info:
        spark._jvm.java.io.FileInputStream("/no/such/file")
    return info.value


def test_chains_run_through_python_and_java(spark):
    assert error_chain(ValueError("x")) == ["ValueError"]
    assert error_chain(raised(RuntimeError("load"), PermissionError("no"))) == ["RuntimeError", "PermissionDenied"]
    assert error_chain(socket.gaierror("who")) == ["UnknownHost"]
    assert error_chain(raised(RuntimeError("load"), TimeoutError())) == ["RuntimeError", "Timeout"]
    assert error_chain(java_error(spark))[-1] == "NotFound"
    with pytest.raises(Exception, match="PATH_NOT_FOUND") as info:
        spark.read.parquet("/no/such/folder")
    assert error_chain(info.value)[0] == "NotFound"
    circle = RuntimeError("a")
    circle.__cause__ = ValueError("b")
    circle.__cause__.__cause__ = circle
    assert error_chain(circle) == ["RuntimeError", "ValueError"]


def test_a_java_cause_below_a_python_error(spark):
    def chain(kind, message):
        return spark._jvm.java.lang.RuntimeException("outer", getattr(spark._jvm, kind)(message))

    class Captured(Exception):
        def __init__(self, origin):
            self._origin = origin

    found = error_chain(Captured(chain("java.net.UnknownHostException", "host")))
    assert found == ["Captured", "RuntimeException", "UnknownHost"]


@pytest.mark.parametrize(
    ("error", "kind"),
    [(PermissionError("no"), "setup"), (FileNotFoundError("gone"), "setup"), (TimeoutError("slow"), "transient")],
)
def test_a_broken_load_is_in_the_log_by_its_class(spark, tmp_path, monkeypatch, error, kind):
    load = Loader(options(tmp_path), events.registry(spark))

    def broken(*_, **__):
        raise RuntimeError("cannot write") from error

    with monkeypatch.context() as patch:
        patch.setattr(loader_module, "write_batch", broken)
        for _ in range(2):
            with pytest.raises(RuntimeError, match="cannot write"):
                load.process(events.lines(spark, events.line("a")), 4)
    load.process(events.lines(spark, events.line("a")), 4)
    log = attempt_log(spark, load.options.manifest)
    assert {tuple(r) for r in metrics.attempt_classes(log).collect()} == {(kind, 2)}
    tries = sorted((r["attempt"], len(r["error_chain"]), r["batch_id"]) for r in log.collect())
    assert tries == [(0, 2, 4), (1, 2, 4), (2, 0, 4)]


def test_a_healthy_load_writes_no_attempt(spark, tmp_path):
    load = Loader(options(tmp_path), events.registry(spark))
    load.process(events.lines(spark, events.line("a")), 0)
    assert not (tmp_path / failures_path("m")).exists()
    assert attempt_log(spark, load.options.manifest).count() == 1


def test_an_error_is_raised_even_if_it_cannot_be_logged(spark, tmp_path, monkeypatch):
    load = Loader(options(tmp_path), events.registry(spark))
    (tmp_path / "m-failures").write_text("a file in the log's place")

    def broken(*_, **__):
        raise PermissionError("cannot write")

    monkeypatch.setattr(loader_module, "write_batch", broken)
    with pytest.raises(PermissionError, match="cannot write") as info:
        load.process(events.lines(spark, events.line("a")), 0)
    assert "missing from the attempt log" in info.value.__notes__[0]


def test_latency_from_the_time_of_the_source(spark, tmp_path):
    load = Loader(options(tmp_path, source_time="timestamp"), events.registry(spark))
    rows = [(events.line("a"), NOON + timedelta(seconds=2)), ("nonsense", NOON), (events.line("b"), None)]
    frame = spark.createDataFrame(rows, "value string, timestamp timestamp")
    assert load.process(frame, 0).ingested == NOON
    assert load.process(frame.where("timestamp IS NULL"), 1).ingested is None
    (row,) = received_log(spark, load.options.manifest).collect()
    waited = metrics.stream_latency(received_log(spark, load.options.manifest)).first()["latency_millis"]
    assert row["batch_id"] == 0 and waited > 1000 * 86400 * 365
    log = spark.read.parquet(load.options.landing)
    assert "_source_time" not in log.columns
