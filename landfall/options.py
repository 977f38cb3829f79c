"""Validated settings of a load."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from landfall.functions.schema_uri import Criterion
from landfall.layout import DEFAULT_LAYOUT, Layout

# Codecs the Parquet writer of a plain Spark install can use.
CODECS = ("snappy", "gzip", "zstd", "lz4_raw", "uncompressed")

# Largest failed event accepted by the usual sinks, in bytes.
FAILED_SIZE_LIMITS = {"kafka": 1_000_000, "kinesis": 1_000_000, "pubsub": 9_000_000}


def codec_name(codec: str) -> str:
    """Codec name in Spark's spelling; any letter case is accepted."""
    name = codec.lower()
    if name not in CODECS:
        raise ValueError(f"unknown codec {codec}; choose one of {', '.join(CODECS)}")
    return name


@dataclass(frozen=True)
class Processor:
    """Who produced a failed event."""

    name: str = "landfall"
    version: str = "0.1.0"


@dataclass(frozen=True)
class LoadOptions:
    landing: str
    failed: str
    manifest: str
    layout: Layout = DEFAULT_LAYOUT
    codec: str = "snappy"
    skip_schemas: tuple[str, ...] = ()
    strict: bool = True
    override_load_time: bool = False
    failed_max_bytes: int = FAILED_SIZE_LIMITS["kafka"]
    # Failed events go to text files below ``failed``, or to any other batch sink that takes
    # a ``value`` column, such as "kafka" with its options.
    failed_format: str = "text"
    failed_options: Mapping[str, str] = field(default_factory=dict)
    target_file_bytes: int = 128 * 1024 * 1024
    # Keep parsed rows between the passes over one batch. Right for a stream, whose
    # batches are bounded; switch off to re-scan the source of a huge static frame.
    cache: bool = True
    # The column of the lines that tells when the source received each, such as Kafka's
    # ``timestamp``; the batch log then knows how long lines waited.
    source_time: str | None = None
    processor: Processor = field(default_factory=Processor)

    def __post_init__(self):
        object.__setattr__(self, "codec", codec_name(self.codec))
        if self.failed_max_bytes <= 0 or self.target_file_bytes <= 0:
            raise ValueError("byte limits must be positive")
        if self.override_load_time and self.layout.load_time not in self.layout.schema.fieldNames():
            raise ValueError(f"layout has no load time field {self.layout.load_time}")
        for text in self.skip_schemas:
            Criterion.parse(text)

    @property
    def criteria(self) -> list[Criterion]:
        return [Criterion.parse(text) for text in self.skip_schemas]
