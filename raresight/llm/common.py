"""Small helpers shared by the operators: Arrow text access, bounded slices, word positions
and stable hashes on UTF-8 bytes, and tables written to the shared folder."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from raresight.session import scratch_path

SLICE_BYTES = 2 << 20  # text handled at once inside a task; a longer document is a slice of its own
NULL_ID = -(1 << 63)  # a null doc_id sorts before every other


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's code to the Python workers (once per application), so that they need no copy of their own."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "raresight")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    path = f"{scratch_path(spark, 'code')}/raresight.zip"
    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(at), recursive=True)
    with store.open_output_stream(at) as f:
        f.write(archive.getvalue())
    context.addPyFile(path)


_RECORDS: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that ``written`` makes inside."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS.remove(paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder (cuts the lineage; survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    for paths in _RECORDS:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables whose readers' results have been stored."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_numbers(column: pa.Array) -> np.ndarray:
    """Document ids as int64; null is the smallest."""
    return pc.fill_null(column.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def id_column(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers, pa.int64(), mask=numbers == NULL_ID)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def cut_bytes(data: bytes, between: re.Pattern, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` in pieces of about ``size``, each cut after a match of ``between``."""
    at = 0
    while at < len(data):
        cut = between.search(data, at + size)
        end = cut.end() if cut else len(data)
        yield data[at:end]
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# Word separators of the contracts: U+0020 and U+0009..U+000D.  They are ASCII, so words can be
# found on UTF-8 bytes.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, row) of every word; words never run over a row's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] |= inside[heads]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    ends[tails] |= inside[tails]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, end, np.searchsorted(offsets, first, side="right") - 1


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
HASH_BYTES = 1 << 20


def word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A stable 64-bit hash of each word's bytes (words in order, not overlapping)."""
    out = np.empty(len(first), np.uint64)
    lengths = end - first
    at = 0
    while at < len(first):
        # a run of words of about HASH_BYTES bytes, so that the per-byte arrays stay small
        stop = max(at + 1, int(np.searchsorted(end, first[at] + HASH_BYTES, side="right")))
        n = lengths[at:stop]
        starts = np.cumsum(n) - n
        total = int(n.sum())
        place = np.arange(total, dtype=np.int64) - np.repeat(starts, n)
        source = place + np.repeat(first[at:stop], n)
        value = BYTE_VALUE[data[source]]
        value *= powers(int(n.max()))[place]
        out[at:stop] = np.add.reduceat(value, starts) + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at = stop
    return mix64(out)


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 256), 0xC2B2AE3D27D4EB4F, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS

