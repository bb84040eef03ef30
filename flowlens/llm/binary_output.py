"""Token ids as flat unsigned integer files with 64-bit document offsets, memory-mapped for reading.

Every partition of the id order writes three files: ``ids`` (little-endian unsigned integers), ``offsets``
(64-bit, one more than documents) and ``docs`` (64-bit ids, then one byte each that tells a missing id).
A manifest lists the files of the attempts that counted, with bases from prefix sums over partitions.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.llm import tokens
from flowlens.llm.common import text_of

END_ID = 0
MANIFEST = "part int, file string, docs long, ids long"


def _store(path: str):
    """File system and path inside it; a plain path is local or mounted."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def write_ids(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """Write all documents in ascending id order to ``path``; returns and stores the manifest with bases.

    Rows without an id come first; equal ids are ordered by text and may span files. A NULL text is an empty
    document of one end id. A retried task writes under a new name and only its manifest row counts.
    """
    ordered = (docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
               .withColumn("h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
               .select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.byte_ids(tokenizer), np.array([END_ID], "<u2").tobytes()
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        store, base = _store(path)
        store.create_dir(base)
        offsets, ids, missing = [0], [], []
        out = None
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}.ids")
                data = encode(t) + end
                out.write(data)
                offsets.append(offsets[-1] + len(data) // 2)
                ids.append(d or 0)
                missing.append(d is None)
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{base}/{name}.offsets") as f:
            f.write(np.array(offsets, "<u8").tobytes())
        with store.open_output_stream(f"{base}/{name}.docs") as f:
            f.write(np.array(ids, "<i8").tobytes() + np.array(missing, "u1").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "file": [name], "docs": pa.array([len(ids)], pa.int64()),
            "ids": pa.array([offsets[-1]], pa.int64())})

    spark = docs.sparkSession
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/files")
    files = spark.read.schema(MANIFEST).parquet(f"{path}/files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one short row for each file
    files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).write.parquet(f"{path}/manifest")
    return spark.read.schema(f"{MANIFEST}, base long").parquet(f"{path}/manifest")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files alone."""
    manifest = spark.read.schema(f"{MANIFEST}, base long").parquet(f"{path}/manifest")
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(path)
        for b in batches:
            for r in b.to_pylist():
                yield _rows(store, base, r)

    return manifest.repartition(files, "file").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _mapped(store, name: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped into memory on a mounted folder, read from any other store."""
    if type(store).__name__ == "LocalFileSystem":
        return np.memmap(name, dtype=dtype, mode="r")
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype)


def _rows(store, base: str, r: dict) -> pa.RecordBatch:
    name = f"{base}/{r['file']}"
    ids, offsets = _mapped(store, f"{name}.ids", "<u2"), np.asarray(_mapped(store, f"{name}.offsets", "<u8"))
    raw, n = np.asarray(_mapped(store, f"{name}.docs", "u1")), r["docs"]
    docs, missing = raw[: 8 * n].view("<i8"), raw[8 * n:].astype(bool)
    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    start = offsets.astype("i8")
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(docs, pa.int64(), mask=missing), "start": pa.array(start[:-1] + r["base"], pa.int64()),
        "n_tokens": pa.array(np.diff(start), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})
