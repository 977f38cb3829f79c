"""Token ids as flat binary files with 64-bit document offsets, read back through memory maps.

Documents are dealt by ranges of their id, so file *k* holds ids below those of file *k + 1*.
Each task writes three flat files: token ids (unsigned, 16 or 32 bits), offsets (one more than
documents, unsigned 64 bits, within the file) and document ids (signed 64 bits). A task that is
run again writes under new names; the manifest, a table that Spark commits, names the files
that count. The base of a file is the sum of the tokens of the files before it.

Defined results: a null or empty text has the end id alone; null document ids come first;
repeated rows are kept, ordered by text within one id; an empty table gives an empty manifest;
columns beyond the two named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.encoding import encoder
from landfall.llm.shared import Batches, filesystem, new_name, shuffle_width

MANIFEST = "part int, name string, item_bytes int, docs long, null_ids long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, file string"


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Writes the files and their manifest under ``folder``; returns the manifest."""

    def run(batches: Batches) -> Batches:
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        store, path = filesystem(folder)
        store.create_dir(f"{path}/files", recursive=True)
        part = TaskContext.get().partitionId()
        name = new_name(f"{part:06d}")
        tokens = docs_seen = nulls = 0
        streams = [store.open_output_stream(f"{path}/files/{name}.{kind}") for kind in ("ids", "offsets", "docs")]
        ids_file, offsets_file, docs_file = streams
        offsets_file.write(np.zeros(1, "<u8").tobytes())
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            nulls += doc_ids.null_count
            docs_file.write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            pieces = [encode.encode(text or "") + end for text in texts]
            ids_file.write(b"".join(pieces))
            ends = tokens + np.cumsum([len(p) // len(end) for p in pieces], dtype=np.int64)
            offsets_file.write(ends.astype("<u8").tobytes())
            docs_seen += len(texts)
            tokens = int(ends[-1]) if len(ends) else tokens
        for stream in streams:
            stream.close()
        if docs_seen:
            row = [part, name, len(end), docs_seen, nulls, tokens]
            names = [field.split()[0] for field in MANIFEST.split(", ")]
            types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "text")
    )
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with each file's base; it has one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _mapped(store, path: str, kind: str, dtype: str, count: int) -> np.ndarray:
    """A flat file as an array: a memory map where the store is a local or mounted folder."""
    if count == 0:
        return np.empty(0, dtype)
    if store.type_name == "local":
        return np.memmap(f"{path}.{kind}", dtype=dtype, mode="r", shape=(count,))
    with store.open_input_file(f"{path}.{kind}") as file:
        return np.frombuffer(file.read(), dtype)


def read_token_files(
    spark: SparkSession,
    folder: str,
    value: Callable[[np.ndarray], int] = lambda ids: zlib.crc32(ids.astype("<u4").tobytes()),
) -> DataFrame:
    """One row per document, from the files alone; ``value`` sums up a document's ids."""
    manifest = with_bases(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"))

    def run(batches: Batches) -> Batches:
        store, path = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                file = f"{path}/files/{row['name']}"
                ids = _mapped(store, file, "ids", f"<u{row['item_bytes']}", row["tokens"])
                offsets = _mapped(store, file, "offsets", "<u8", row["docs"] + 1).astype(np.int64)
                doc_ids = _mapped(store, file, "docs", "<i8", row["docs"])
                step = 5000
                for i in range(0, row["docs"], step):
                    at = offsets[i : i + step + 1]
                    n = len(at) - 1
                    absent = np.arange(i, i + n) < row["null_ids"]
                    sums = [value(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(doc_ids[i : i + n]), pa.int64(), mask=absent),
                            pa.array(at[:-1] + row["base"], pa.int64()),
                            pa.array(np.diff(at), pa.int64()),
                            pa.array(sums, pa.int64()),
                            pa.array([row["name"]] * n, pa.string()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "file"],
                    )

    return manifest.repartition(shuffle_width(spark), "part").mapInArrow(run, DOCUMENTS)
