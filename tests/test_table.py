"""Landing folder, failed sink, sources, the table over the folder."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import events
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from landfall.operators.registry import registry_from_folder
from landfall.operators.table import cluster, file_stats, read_between, with_load_tstamp
from landfall.options import CODECS
from landfall.sources import lines as sources
from landfall.sources.failed import failed_json, send_failed
from landfall.sources.landing import (
    batch_folder,
    file_count,
    landing_schema,
    load_date,
    read_landing,
    session_conf,
    write_batch,
    write_partitioned,
)
from landfall.sources.manifest import Manifest, read_committed
from landfall.streaming.table import ingest, read_table, stream_landing

TIME = datetime(2024, 2, 29, 23, 59, 59, tzinfo=UTC)


@pytest.mark.parametrize("codec", CODECS)
def test_physical_types_and_codec(spark, tmp_path, codec):
    rows = spark.sql(
        "SELECT CAST(1 AS DECIMAL(9,2)) a, CAST(1 AS DECIMAL(18,2)) b, CAST(1 AS DECIMAL(38,2)) c,"
        " timestamp_millis(5) t, DATE'2024-01-01' d, array('x') l"
    )
    write_batch(rows, str(tmp_path / "x"), codec.upper())
    (file,) = (tmp_path / "x").glob("*.parquet")
    parquet = pq.ParquetFile(file)
    kinds = {parquet.schema.column(i).path: parquet.schema.column(i) for i in range(6)}
    assert [kinds[c].physical_type for c in "abc"] == ["INT32", "INT64", "FIXED_LEN_BYTE_ARRAY"]
    assert kinds["c"].length == 16
    assert kinds["t"].physical_type == "INT64" and "timeUnit=microseconds" in str(kinds["t"].logical_type)
    assert "isAdjustedToUTC=true" in str(kinds["t"].logical_type)
    assert "Date" in str(kinds["d"].logical_type) and "l.list.element" in kinds
    written = parquet.metadata.row_group(0).column(0).compression.lower()
    assert codec.startswith(written.replace("lz4", "lz4_raw")[:4]) or written == codec


def test_session_options_are_put_back(spark):
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    with session_conf(spark, {key: "TIMESTAMP_MICROS"}):
        assert spark.conf.get(key) == "TIMESTAMP_MICROS"
    assert spark.conf.get(key) == before


def test_load_date_is_the_utc_day(spark, tmp_path):
    assert load_date(datetime.fromisoformat("2024-03-01T00:30:00+02:00")) == "2024-02-29"
    rows = spark.sql("SELECT timestamp_millis(1709251199000) t UNION ALL SELECT timestamp_millis(1709251200000)")
    write_partitioned(rows, str(tmp_path), F.col("t"), spread="t")
    assert sorted(p.name for p in tmp_path.glob("load_*")) == [
        "load_tstamp_date=2024-02-29",
        "load_tstamp_date=2024-03-01",
    ]


def test_landing_reads_old_and_new_columns(spark, tmp_path):
    landing = str(tmp_path)
    write_batch(spark.sql("SELECT 1 a, named_struct('x', 1) s"), batch_folder(landing, TIME, "q-0"))
    write_batch(
        spark.sql("SELECT 2 a, named_struct('x', 2, 'y', 'n') s, 'new' b"),
        batch_folder(landing, TIME, "q-1"),
    )
    rows = read_landing(spark, landing)
    assert {(r["a"], r["s"]["y"], r["b"]) for r in rows.collect()} == {(1, None, None), (2, "n", "new")}
    assert set(landing_schema(spark, landing).fieldNames()) == {"a", "s", "b"}
    assert read_landing(spark, landing, modified_after="2999-01-01T00:00:00").count() == 0


def test_table_takes_up_new_columns_and_no_file_twice(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("l", "t", "c"))

    def run():
        ingest(spark, landing, table, checkpoint).awaitTermination()
        return read_table(spark, table)

    write_batch(spark.sql("SELECT 1 a"), batch_folder(landing, TIME, "q-0"))
    assert run().count() == 1 and run().count() == 1
    write_batch(spark.sql("SELECT 2 a, 'new' b"), batch_folder(landing, TIME, "q-1"))
    rows = run()
    assert {(r["a"], r["b"]) for r in rows.collect()} == {(1, None), (2, "new")}
    assert rows.where("load_tstamp IS NULL").count() == 0
    assert "load_tstamp_date" not in rows.columns


def test_table_can_leave_out_files_from_before(spark, tmp_path):
    landing = str(tmp_path / "l")
    write_batch(spark.sql("SELECT 1 a"), batch_folder(landing, TIME, "q-0"))
    later = F.timestamp_micros(F.lit(int(datetime(2999, 1, 1, tzinfo=UTC).timestamp()) * 1_000_000))
    for limit, expected in ((later, 0), (F.timestamp_micros(F.lit(0)), 1)):
        name = f"landed_{expected}"
        rows = stream_landing(spark, landing, limit)
        writer = rows.writeStream.format("memory").queryName(name).trigger(availableNow=True)
        writer.start().awaitTermination()
        assert spark.table(name).count() == expected


def test_clustering_cuts_a_hot_key(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id AS event_id", "'hot' AS event_name")
    rows = with_load_tstamp(rows, F.timestamp_millis(F.lit(0)))
    clustered = cluster(rows, partitions=4)
    sizes = [r[1] for r in clustered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    clustered.write.parquet(str(tmp_path / "t"))
    stats = file_stats(spark.read.parquet(str(tmp_path / "t")))
    assert stats.agg(F.sum("rows")).first()[0] == 4000
    assert {tuple(r) for r in stats.select("min_event_name", "max_event_name").collect()} == {("hot", "hot")}
    assert "min_true_tstamp" not in stats.columns


def test_failed_json(spark, tmp_path):
    rows = spark.createDataFrame(
        [("p", "v", "why", "short"), ("p", "v", "why", "é" * 200)],
        "processor_name string, processor_version string, failure string, payload string",
    )
    texts = failed_json(rows, 200)
    first, second = (json.loads(r[0]) for r in texts.collect())
    assert first == {
        "processor_name": "p",
        "processor_version": "v",
        "failure": "why",
        "payload": "short",
    }
    assert second["payload"] == "é" * 20
    whole = {**first, "payload": "é" * 200}
    size = len(json.dumps(whole, ensure_ascii=False, separators=(",", ":")).encode())
    assert second["failure"] == f"size violation: {size} bytes exceed 200"
    send_failed(texts, "parquet", {"path": str(tmp_path / "out")})
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_registry_key_is_the_path(spark, tmp_path):
    for name in ("no-fields-v1", "no-fields-v2"):
        folder = tmp_path / "my vendor" / name / "jsonschema"
        folder.mkdir(parents=True)
        (folder / "1-0-2").write_text('{"self":{"name":"no-fields"},\n"type":"object"}')
    rows = registry_from_folder(spark, str(tmp_path)).collect()
    assert {tuple(r)[:5] for r in rows} == {
        ("my vendor", "no-fields-v1", 1, 0, 2),
        ("my vendor", "no-fields-v2", 1, 0, 2),
    }
    assert json.loads(rows[0]["schema_json"])["type"] == "object"


def test_source_options():
    options = sources.kafka_source("topic", "host:1", "earliest", {"group.id": "g"}, 500)
    assert options == {
        "subscribe": "topic",
        "kafka.bootstrap.servers": "host:1",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "500",
    }
    assert sources.kafka_source("t", "h")["startingOffsets"] == "latest"
    start = sources.start_position(datetime(2020, 7, 17, 10, tzinfo=UTC))
    assert start["startingTimestamp"] == "1594980000000"
    assert sources.kafka_sink("t", "h", {"client.id": "c"})["kafka.client.id"] == "c"
    assert sources.batch_limits() == {"maxBytesPerTrigger": "16000000"}
    assert sources.batch_limits(1000, mean_line_bytes=300) == {"maxOffsetsPerTrigger": "3"}
    assert sources.delay_trigger(1.5) == {"processingTime": "1500 milliseconds"}
    for bad in ("middle", datetime(2020, 1, 1)):
        with pytest.raises(ValueError):
            sources.start_position(bad)


def test_spread_leaves_wide_sources_alone(spark):
    wide = spark.range(100, numPartitions=50)
    assert sources.spread(wide) is wide
    for stable in (False, True):
        dealt = sources.spread(spark.range(100, numPartitions=1), stable_order=stable)
        assert dealt.rdd.getNumPartitions() == 8
        assert sorted(r[0] for r in dealt.collect()) == list(range(100))


def test_size_limit_makes_several_batches(spark, tmp_path):
    for i in range(3):
        events.lines(spark, "x" * 500).coalesce(1).write.text(str(tmp_path / "s" / f"p{i}"))
    limits = sources.batch_limits(max_bytes=600) | {"recursiveFileLookup": "true"}
    stream = sources.stream_lines(spark, "text", limits, str(tmp_path / "s"))
    seen = []
    query = (
        stream.writeStream.foreachBatch(lambda df, i: seen.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sum(seen) == 3 and len(seen) >= 2


def started(spark, tmp_path, **changes):
    paths = [str(tmp_path / n) for n in ("l", "t", "c")]
    return ingest(spark, *paths, processingTime="0 seconds", **changes), *paths[:2]


def test_a_running_table_stream_takes_up_new_columns_and_fields(spark, tmp_path):
    landing = str(tmp_path / "l")
    write_batch(spark.sql("SELECT 1 a, named_struct('x', 1) s"), batch_folder(landing, TIME, "q-0"))
    stream, _, table = started(spark, tmp_path)
    try:
        stream.processAllAvailable()
        wider = spark.sql("SELECT CAST(id + 2 AS INT) a, named_struct('x', 2, 'y', 'n') s, array(id) b FROM range(5)")
        write_batch(wider.repartition(3), batch_folder(landing, TIME, "q-1"))
        stream.processAllAvailable()
        write_batch(spark.sql("SELECT 9 a, named_struct('x', 3) s"), batch_folder(landing, TIME, "q-2"))
        stream.processAllAvailable()
    finally:
        stream.stop()
    rows = read_table(spark, table)
    assert rows.columns == ["a", "s", "load_tstamp", "b"]
    found = {(r["a"], r["s"]["y"], tuple(r["b"] or ())) for r in rows.collect()}
    assert found == {(1, None, ()), (9, None, ()), *[(i + 2, "n", (i,)) for i in range(5)]}
    assert rows.where("load_tstamp IS NULL").count() == 0


def test_columns_that_do_not_merge_stop_the_table_before_it_commits(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("l", "t", "c"))
    write_batch(spark.sql("SELECT 1 a"), batch_folder(landing, TIME, "q-0"))
    ingest(spark, landing, table, checkpoint).awaitTermination()
    broken = batch_folder(landing, TIME, "q-1")
    write_batch(spark.sql("SELECT 'text' a"), broken)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="int and string"):
            ingest(spark, landing, table, checkpoint).awaitTermination()
        assert [r["a"] for r in read_table(spark, table).collect()] == [1]
    # the file was not counted as read: repaired, it is loaded
    write_batch(spark.sql("SELECT 2 a"), broken)
    ingest(spark, landing, table, str(tmp_path / "c2"), landed_after=F.timestamp_micros(F.lit(0))).awaitTermination()
    assert sorted(r["a"] for r in read_table(spark, table).collect()) == [1, 1, 2]


def test_a_table_batch_that_is_tried_again_is_not_doubled(spark, tmp_path, monkeypatch):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("l", "t", "c"))
    write_batch(spark.sql("SELECT id a FROM range(10)"), batch_folder(landing, TIME, "q-0"))

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "commit", crash)
        with pytest.raises(StreamingQueryException, match="lost"):
            ingest(spark, landing, table, checkpoint).awaitTermination()
    ingest(spark, landing, table, checkpoint).awaitTermination()
    assert len(list((tmp_path / "t").rglob("load_attempt=*"))) == 2
    assert sorted(r["a"] for r in read_table(spark, table).collect()) == list(range(10))


def test_a_file_without_rows_gives_the_table_its_columns(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("l", "t", "c"))
    write_batch(spark.sql("SELECT 1 a, 'x' b").where("false"), batch_folder(landing, TIME, "seed"))
    ingest(spark, landing, table, checkpoint).awaitTermination()
    rows = read_table(spark, table)
    assert rows.columns == ["a", "b", "load_tstamp"] and rows.count() == 0


def test_the_table_follows_committed_batches_alone(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "log"), "load")
    landing, table, checkpoint = (str(tmp_path / n) for n in ("l", "t", "c"))
    for batch in range(3):
        lost = manifest.start(batch)
        write_batch(spark.sql(f"SELECT {batch} a, 'lost' b"), batch_folder(landing, lost.load_tstamp, f"load-{batch}", lost.number))
        kept = manifest.start(batch)
        folder = batch_folder(landing, kept.load_tstamp, f"load-{batch}", kept.number)
        write_batch(spark.sql(f"SELECT {batch} a, 'kept' b"), folder)
        if batch < 2:
            manifest.commit(batch, kept, good=1, bad=0, folder=folder)
    ingest(spark, landing, table, checkpoint, manifest=str(tmp_path / "log"), cluster_by=("a", "none")).awaitTermination()
    assert {(r["a"], r["b"]) for r in read_table(spark, table).collect()} == {(0, "kept"), (1, "kept")}
    assert {r["a"] for r in read_committed(spark, str(tmp_path / "log"), landing).collect()} == {0, 1}


def test_an_index_leaves_files_out_of_a_clustered_table_only(spark, tmp_path):
    rows = spark.range(6000).selectExpr("id AS event_id", "pmod(xxhash64(id), 1000) AS place")
    low, high = F.lit(100), F.lit(140)
    read = {}
    for name, frame in (("plain", rows.repartition(12)), ("clustered", cluster(rows, ("place",), partitions=12))):
        path = str(tmp_path / name)
        frame.write.parquet(path)
        index = file_stats(spark.read.parquet(path), ("place",))
        found, files = read_between(index, rows.schema, "place", low, high)
        read[name] = files
        assert found.count() == rows.where("place BETWEEN 100 AND 140").count()
        assert len(found.inputFiles()) == files
    assert read["plain"] == 12 and read["clustered"] <= 3
    none, files = read_between(index, rows.schema, "place", F.lit(2000), F.lit(3000))
    assert (none.count(), files) == (0, 0)


def test_spread_deals_out_a_file_that_cannot_be_cut(spark, tmp_path):
    """One row group, planned as a split for each core: one of them would get every row."""
    path = str(tmp_path / "one-row-group")
    spark.range(20_000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS text").coalesce(1).write.parquet(path)
    (file,) = (tmp_path / "one-row-group").glob("*.parquet")
    cuts = {"spark.sql.files.maxPartitionBytes": str(file.stat().st_size // 10), "spark.sql.files.openCostInBytes": "1"}
    with session_conf(spark, cuts):
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() >= 8
        for stable in (False, True):
            per_task = sources.spread(rows, stable_order=stable).groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in per_task) == 20_000 and max(r["count"] for r in per_task) < 5_000


def test_a_few_more_files_than_cores_are_whole_rounds_of_tasks():
    target = 128 * 1024 * 1024
    assert [file_count(n * target, target, 8) for n in (8, 9, 17, 31, 33)] == [8, 16, 24, 32, 33]


def test_clustering_cuts_a_large_input_into_more_ranges(spark):
    """Sorted rows of a task stay bounded: ranges grow with the splits, not only with the session's setting."""
    small, large = (spark.range(0, 40_000, 1, n).selectExpr("id AS event_id", "'e' AS event_name") for n in (1, 12))
    assert cluster(small, ("event_name",)).rdd.getNumPartitions() <= 8
    ranges = cluster(large, ("event_name",)).groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) == 48 and sum(r["count"] for r in ranges) == 40_000


def test_kept_registry_is_the_registry(spark, tmp_path):
    from landfall.queries import inputs

    sf = str(tmp_path)
    spark.createDataFrame([("error",), ("click",), ("error",)], "event_type string").write.parquet(f"{sf}/events.parquet")
    kept = inputs.kept_registry(spark, sf)
    assert "events.parquet" not in kept._jdf.queryExecution().toString()
    assert sorted(kept.collect()) == sorted(inputs.registry(spark, sf).collect())


def test_file_stats_do_not_sort_the_rows_of_a_file(spark, tmp_path):
    """Rows are hashed by file and text; only the distinct texts are sorted."""
    name = "CASE WHEN id % 7 > 0 THEN concat('e', id % 3) END AS event_name"
    spark.range(1_000).selectExpr(name, "timestamp_seconds(id) AS load_tstamp").coalesce(1).write.parquet(str(tmp_path / "t"))
    stats = file_stats(spark.read.parquet(str(tmp_path / "t")))
    row = stats.select("rows", "min_event_name", "max_event_name", F.unix_seconds("max_load_tstamp").alias("max")).first()
    assert tuple(row) == (1_000, "e0", "e2", 999)
    lines = stats._jdf.queryExecution().executedPlan().toString().splitlines()
    last = [line for line in lines if "Aggregate(" in line or "Sort [" in line][-1]
    assert "+- HashAggregate" in last or " HashAggregate(" in last
