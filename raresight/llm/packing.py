"""Packing documents into sequences of a fixed number of tokens.

A document's ids are cut into whole sequences and one rest.  The rests are packed by
shortest-pack-first over the histogram of their lengths: lengths longest first, each going to the
packs that are emptiest so far, kept as counts of equal packing patterns.  The work on the driver
depends on the sequence length alone, never on the number of documents.  The n-th document of a
length takes the n-th place that the patterns have for that length; ranks come from counts per
(length, part) and their prefix sums, so no task sees all documents of a length.

Null text is an empty document (the end id alone); a null or repeated doc_id is no problem (rows
have a number of their own); an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.llm import token_ids
from raresight.llm.common import byte_slices, written

Pattern = tuple[tuple[int, int], ...]  # (length, times), longest first


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """(pattern, number of packs) for ``histogram`` (length -> number of rests)."""
    open_packs: dict[int, list[tuple[Pattern, int]]] = {}  # by length so far
    order: list[int] = []  # heap of those lengths

    def put(pattern: Pattern, length: int, times: int, total: int, packs: int) -> None:
        total += length * times
        if total not in open_packs:
            heapq.heappush(order, total)
            open_packs[total] = []
        open_packs[total].append((pattern + ((length, times),), packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            total = order[0] if order else capacity
            if total + length > capacity:  # it fits nowhere: new packs, as full as this length makes them
                each = capacity // length
                if left // each:
                    put((), length, each, 0, left // each)
                if left % each:
                    put((), length, left % each, 0, 1)
                break
            pattern, packs = open_packs[total].pop()
            if not open_packs[total]:
                del open_packs[total]
                heapq.heappop(order)
            # so many of this length into each of these packs at once
            times = max(1, min(left // packs, (capacity - total) // length))
            used = min(packs, left // times)
            left -= used * times
            put(pattern, length, times, total, used)
            if used < packs:
                if total not in open_packs:
                    heapq.heappush(order, total)
                    open_packs[total] = []
                open_packs[total].append((pattern, packs - used))
    return [x for total in sorted(open_packs) for x in open_packs[total]]


def slots(patterns: list[tuple[Pattern, int]]) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """(length, first rank, end rank, times in a pack, first sequence, offset) of every place, and the number of sequences."""
    out, taken, sequence = [], {}, 0
    for pattern, packs in patterns:
        offset = 0
        for length, times in pattern:
            first = taken.get(length, 0)
            taken[length] = first + packs * times
            out.append((length, first, taken[length], times, sequence, offset))
            offset += length * times
        sequence += packs
    return out, sequence


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, added: bool = False) -> DataFrame:
    """A written table: row (unique), part, doc_id, n_tokens, ids (little-endian unsigned 16 or 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in byte_slices(batches, "text"):
            ids, counts = token_ids.encode_column(batch.column("text"), vocabulary, end_id, added)
            kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
            raw = ids.astype(kind)
            bounds = (np.concatenate([[0], np.cumsum(counts)]) * raw.itemsize).astype(np.int32)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array((np.int64(part) << 33) + np.arange(row, row + n)), pa.array(np.full(n, part, np.int64)), batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])], ["row", "part", "doc_id", "n_tokens", "ids"])
            row += n

    return written(docs.select("doc_id", "text").mapInArrow(run, "row long, part long, doc_id long, n_tokens long, ids binary"), "pack-tokens")


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 2048, added: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, little-endian unsigned 32-bit).
    ``added``: see ``token_ids``."""
    spark = docs.sparkSession
    tokens = tokenized(docs, vocabulary, end_id, added)
    sizes = tokens.select("row", "part", F.expr(f"n_tokens div {capacity}").alias("whole"), (F.col("n_tokens") % capacity).alias("rest"))
    # at most ``capacity`` rows
    histogram = {r["rest"]: r["n"] for r in sizes.filter("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}
    places, packed = slots(pack_histogram(histogram, capacity))

    counted = sizes.groupBy("part", "rest").agg(F.count("*").alias("n"))
    before = counted.withColumn("rank0", F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    # one row per part
    wholes = (sizes.groupBy("part").agg(F.sum("whole").alias("n"))
              .withColumn("whole0", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + packed).drop("n"))
    in_part = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (sizes.withColumn("whole_before", F.coalesce(F.sum("whole").over(in_part), F.lit(0)))
              .withColumn("rank_in", F.row_number().over(Window.partitionBy("part", "rest").orderBy("row")) - 1)
              .join(before, ["part", "rest"]).join(wholes, "part")
              .select("row", "rest", (F.col("rank0") + F.col("rank_in")).alias("rank"), (F.col("whole0") + F.col("whole_before")).alias("first_whole")))
    # the places depend on ``capacity`` alone, so their broadcast does not grow with the documents
    table = spark.createDataFrame(places or [(0, 0, 0, 1, 0, 0)], "rest long, lo long, hi long, times long, sequence0 long, offset0 long")
    placed = (ranked.join(F.broadcast(table), "rest", "left").filter("rest = 0 or (rank >= lo and rank < hi)")
              .select("row", "first_whole", F.expr("sequence0 + (rank - lo) div times").alias("rest_sequence"),
                      F.expr("offset0 + (rank - lo) % times * rest").alias("rest_offset")))
    joined = tokens.join(placed, "row").select("doc_id", "n_tokens", "ids", "first_whole", "rest_sequence", "rest_offset")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                rows = []
                for r in whole.slice(at, 256).to_pylist():
                    n = r["n_tokens"]
                    ids = np.frombuffer(r["ids"], f"<u{len(r['ids']) // n}").astype("<u4")
                    for k in range(-(-n // capacity)):
                        start, length = k * capacity, min(capacity, n - k * capacity)
                        sequence, offset = (r["first_whole"] + k, 0) if length == capacity else (r["rest_sequence"], r["rest_offset"])
                        rows.append((r["doc_id"], start, length, n, sequence, offset, ids[start: start + length].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [*[pa.int64()] * 6, pa.binary()])],
                                                 ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    fields = [T.StructField(c, T.LongType(), c == "doc_id") for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
    return joined.mapInArrow(cut, T.StructType([*fields, T.StructField("ids", T.BinaryType(), False)]))
