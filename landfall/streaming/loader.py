"""The whole load, the same for one batch of a stream and for a static frame."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import UTC, datetime
from threading import Event
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landfall.functions.schema_uri import key_parts, key_text, matches_any
from landfall.operators.entities import SEEN, SEEN_KEY, spread_items
from landfall.operators.parse import BYTES, FAILURE, failed_rows, parse_lines
from landfall.operators.project import assemble, override_load_time, transform_events
from landfall.operators.registry import registered_versions, resolve
from landfall.options import LoadOptions
from landfall.plans.columns import EntityColumn, SeenVersion, plan_columns
from landfall.sources.attempts import failures_path, record_failure
from landfall.sources.failed import failed_json, send_failed, write_failed
from landfall.sources.landing import batch_folder, file_count, seed, write_batch
from landfall.sources.ledger import TypeLedger
from landfall.sources.lines import spread
from landfall.sources.manifest import Attempt, Manifest, instant

# How many unregistered versions the message names; the table it points to has all.
_FIRST_MISSING = 20
# The source's time of each line, while it is parsed.
SOURCE_TIME = "_source_time"
# How often a batch plans its columns again because other loads claimed theirs.
_CLAIMS = 5


class MissingSchemas(Exception):
    """Events refer to schemas that are not registered."""


@dataclass(frozen=True)
class BatchPlan:
    """What one pass over a batch tells: its sums, its columns, its unregistered items."""

    rows: int
    bytes: int
    earliest: datetime | None
    ingested: datetime | None
    columns: list[EntityColumn]
    known: list[str]
    missing_items: int
    seen: list[SeenVersion]
    texts: dict


@dataclass(frozen=True)
class BatchResult:
    good: int
    bad: int
    bytes: int
    earliest: datetime | None
    columns: tuple[EntityColumn, ...] = ()
    repeated: bool = False
    folder: str | None = None
    ingested: datetime | None = None


def plan_batch(
    parsed: DataFrame,
    registry: DataFrame,
    options: LoadOptions,
    ledger: TypeLedger | None = None,
    known: SchemaTexts | None = None,
) -> BatchPlan:
    """Discover and resolve the schema versions of a batch, in one aggregation.

    The driver receives one row per *registered* version; everything else is summed into
    a single row before it leaves the executors, so junk references cannot flood it.
    """
    stats = _version_stats(parsed, options)
    rows = (
        resolve(stats, registry)
        .withColumn("registered", F.col("schema_json").isNotNull())
        .select(
            *[F.when(F.col("registered") & ~F.col("skipped"), F.col(c)).alias(c) for c in SEEN],
            "rows",
            "bytes",
            "earliest",
            "ingested",
            F.when(_is_missing(), F.col("items")).otherwise(0).alias("missing_items"),
        )
        .groupBy(*SEEN)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.unix_micros(F.min("earliest")).alias("earliest"),
            F.unix_micros(F.min("ingested")).alias("ingested"),
            F.sum("missing_items").alias("missing_items"),
        )
        .collect()
    )
    missing_items = sum(r["missing_items"] for r in rows)
    if missing_items and options.strict:
        raise MissingSchemas(_missing_message(stats, registry, options.manifest))
    seen = [SeenVersion(*[r[c] for c in SEEN]) for r in rows if r["kind"] is not None]
    texts = (known or SchemaTexts(registry)).of(seen)
    landed = ledger.types(s.entity for s in seen) if ledger else {}
    return BatchPlan(
        rows=sum(r["rows"] for r in rows),
        bytes=sum(r["bytes"] or 0 for r in rows),
        earliest=_least(rows, "earliest"),
        ingested=_least(rows, "ingested"),
        columns=plan_columns(seen, texts, landed),
        known=sorted({key_text(*s.schema_key, *s.version) for s in seen}),
        missing_items=missing_items,
        seen=seen,
        texts=texts,
    )


def _least(rows: list, name: str) -> datetime | None:
    times = [r[name] for r in rows if r[name] is not None]
    return instant(min(times)) if times else None


def settle_columns(plan: BatchPlan, ledger: TypeLedger) -> BatchPlan:
    """The plan with columns that the ledger holds, also if others claim types meanwhile."""
    for _ in range(_CLAIMS):
        held = ledger.claim(plan.columns)
        agreed = all(c.recovered or held[c.kind, c.vendor, c.name, c.model] == c.data_type for c in plan.columns)
        if agreed:
            return plan
        plan = replace(plan, columns=plan_columns(plan.seen, plan.texts, held))
    raise RuntimeError(f"other loads changed the types in {ledger.path} {_CLAIMS} times")


def _version_stats(parsed: DataFrame, options: LoadOptions) -> DataFrame:
    """Per schema version of good rows: its items, and the sums of rows whose own it is."""
    time = options.layout.event_time
    good = F.col(FAILURE).isNull()
    ingested = F.lit(None).cast("timestamp") if options.source_time is None else F.col(SOURCE_TIME)
    spread = spread_items(parsed, BYTES, F.when(good, F.col(time)).alias("time"), ingested.alias("ingested"))
    first = F.col("position") == 0
    stats = spread.groupBy(*SEEN_KEY).agg(
        F.count("key").alias("items"),
        F.count_if(first).alias("rows"),
        F.sum(F.when(first, F.col(BYTES))).alias("bytes"),
        F.min("time").alias("earliest"),
        F.min("ingested").alias("ingested"),
    )
    return stats.select(
        "*", *key_parts("key"), F.expr(matches_any(options.criteria, "key")).alias("skipped")
    )


def _is_missing() -> Column:
    return F.col("key").isNotNull() & F.col("schema_json").isNull() & ~F.col("skipped")


class SchemaTexts:
    """Registered versions of the models that batches had, as schema texts.

    A model's versions are read from the registry when a batch has one that is not among them. A version that
    is registered but never seen doesn't change a column that has landed, so there is no need to look for it.
    """

    def __init__(self, registry: DataFrame):
        self.registry = registry
        self._known: dict = {}

    def of(self, seen: list[SeenVersion]) -> dict:
        lacking = {s.schema_key for s in seen if s.version not in self._known.get(s.schema_key, {})}
        if lacking:
            self._known |= self._read(sorted(lacking))
        return {s.schema_key: self._known[s.schema_key] for s in seen}

    def _read(self, models: list) -> dict:
        keys = [F.struct(F.lit(v).alias("vendor"), F.lit(n).alias("name"), F.lit(m).alias("model")) for v, n, m in models]
        wanted = self.registry.sparkSession.range(1).coalesce(1).select(F.inline(F.array(*keys)))
        texts: dict = {model: {} for model in models}
        for row in registered_versions(self.registry, wanted).collect():
            model = texts[row["vendor"], row["name"], row["model"]]
            model[row["revision"], row["addition"]] = row["schema_json"]
        return texts


def _missing_message(stats: DataFrame, registry: DataFrame, manifest: str) -> str:
    """Writes all unregistered versions with their items beside the batch log, and says where."""
    found = resolve(stats, registry).where(_is_missing()).groupBy("key").agg(F.sum("items").alias("items"))
    table = f"{manifest.rstrip('/')}-missing/{uuid4().hex}"
    found.write.parquet(table)
    written = stats.sparkSession.read.schema(found.schema).parquet(table)
    first = [r["key"] for r in written.orderBy("key").limit(_FIRST_MISSING).collect()]
    return (
        f"{written.count()} schema versions have no registered schema; all are listed with their items in {table}. "
        f"Add them to the registry, name them in skip_schemas, or set strict=False. The first: {', '.join(first)}"
    )


def _logged_type(column: EntityColumn) -> str:
    return T.StructType([T.StructField(column.column, column.output_type)]).json()


class Loader:
    """Loads batches of lines.

    A batch is known by the load and its number within it. The batches of a stream belong to
    the stream's own id, which lives in its checkpoint; static frames belong to ``name``, and
    each new one needs a number of its own. So neither a second stream nor a new checkpoint
    is ever taken for batches that were loaded before.
    """

    def __init__(self, options: LoadOptions, registry: DataFrame, name: str = "load"):
        self.options = options
        self.registry = registry
        self.name = name
        self.ledger = TypeLedger(registry.sparkSession, f"{options.manifest.rstrip('/')}-types")
        self.known = SchemaTexts(registry)

    def seed(self, load_time: datetime) -> str:
        """Land the empty first file."""
        return seed(self.registry.sparkSession, self.options.layout, self.options.landing, load_time)

    def transform(self, parsed: DataFrame, plan: BatchPlan) -> DataFrame:
        options = self.options
        return transform_events(
            parsed,
            options.layout,
            plan.columns,
            known=plan.known if plan.missing_items else None,
            skipped=options.criteria,
        )

    def process(self, lines: DataFrame, batch_id: int, load: str | None = None) -> BatchResult:
        """Parse, split, type and land one batch: failed events first, then good rows."""
        options = self.options
        load = self.name if load is None else load
        manifest = Manifest(lines.sparkSession, options.manifest, load)
        attempt = manifest.start(batch_id)
        if attempt.committed:
            return BatchResult(0, 0, 0, None, repeated=True)
        started = datetime.now(UTC)
        try:
            result = self._try(lines, f"{load}-{batch_id}", attempt)
            manifest.commit(
                batch_id,
                attempt,
                good=result.good,
                bad=result.bad,
                bytes=result.bytes,
                earliest=result.earliest,
                columns={c.column: _logged_type(c) for c in result.columns},
                folder=result.folder,
                ingested=result.ingested,
            )
        except Exception as e:
            record_failure(lines.sparkSession, failures_path(options.manifest), load, batch_id, attempt.number, started, e)
            raise
        return result

    def _try(self, lines: DataFrame, tag: str, attempt: Attempt) -> BatchResult:
        options, keep = self.options, ()
        if options.source_time is not None:
            lines, keep = lines.withColumn(SOURCE_TIME, F.col(options.source_time).cast("timestamp")), (SOURCE_TIME,)
        parsed = parse_lines(spread(lines), options.layout, keep=keep)
        if options.cache:
            parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._load(parsed, tag, attempt)
        finally:
            if options.cache:
                parsed.unpersist()

    def _load(self, parsed: DataFrame, tag: str, attempt: Attempt) -> BatchResult:
        options, load_time = self.options, attempt.load_tstamp
        plan = settle_columns(plan_batch(parsed, self.registry, options, self.ledger, self.known), self.ledger)
        events = self.transform(parsed, plan)
        bad = self._send_failed(events, tag) if plan.rows else 0
        good = plan.rows - bad
        folder = batch_folder(options.landing, load_time, tag, attempt.number) if good else None
        if good:
            if options.override_load_time:
                now = F.timestamp_micros(F.lit(int(load_time.timestamp() * 1_000_000)))
                events = override_load_time(events, options.layout, now)
            landed = assemble(events, options.layout, plan.columns)
            cores = parsed.sparkSession.sparkContext.defaultParallelism
            files = file_count(plan.bytes, options.target_file_bytes, cores)
            write_batch(landed, folder, options.codec, files, mode="errorifexists")
        columns = tuple(plan.columns) if good else ()
        return BatchResult(good, bad, plan.bytes, plan.earliest, columns, folder=folder, ingested=plan.ingested)

    def _send_failed(self, events: DataFrame, tag: str) -> int:
        """Send a batch's failed events; returns how many there are."""
        options = self.options
        failed = failed_rows(events, options.processor)
        texts = failed_json(failed, options.failed_max_bytes)
        if options.failed_format == "text":
            return write_failed(texts, options.failed, tag)
        return send_failed(texts, options.failed_format, dict(options.failed_options))

    def run(self, lines: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start the stream. A batch counts as read only once ``process`` has returned."""
        started, load = Event(), []

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            started.wait()
            self.process(batch, batch_id, load[0])

        writer = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        query = writer.trigger(**(trigger or {"availableNow": True})).start()
        load.append(f"{self.name}-{query.id}")
        started.set()
        return query
