"""Blocks of documents, and questions from blocks that are answered per key range.

A block is a row that holds a few MB of documents (all columns) as one compressed Arrow batch.  The
table of blocks is written to the shared folder, so a block keeps its number however often it is
read again.  A round goes like this: every block works out its keys and sends them, packed and
sorted, to key ranges; a range looks at what all blocks sent and answers each block with one bit per
key; the answers are joined back to the blocks.  Only packed keys and bits move, keys that repeat
inside a block move once, and no task sees more than one range or one block at a time.

Three kinds of round: ``sketch`` (a count-min sketch: one partial sketch per block, merged per range
of cells; the answer is whether the merged estimate reaches a count, which is never too low),
``levels`` (such a sketch whose answers tell how large the merged estimate is) and ``first`` (exact: whether another block holds the same 128-bit key at an earlier place).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.llm.common import SLICE_BYTES, byte_slices, mix64, written

CODEC = "zstd"


def squeeze(*arrays: np.ndarray) -> bytes:
    raw = b"".join(a.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + bytes(pa.compress(raw, codec=CODEC, asbytes=True))


def expand(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec=CODEC, asbytes=True)


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=CODEC)) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def block_table(docs: DataFrame, text: str, block_bytes: int = SLICE_BYTES) -> DataFrame:
    """The written table (block, n_bytes, payload) of ``docs``; ``text`` is the column that sizes the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in byte_slices(batches, text, block_bytes):
            size = pa.compute.sum(pa.compute.binary_length(batch.column(text))).as_py() or 0
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([pack_batch(batch)], pa.binary())], ["block", "n_bytes", "payload"])
            number += 1

    return written(docs.mapInArrow(run, "block long, n_bytes long, payload binary"), "blocks")


def total_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum("n_bytes")).first()[0] or 0


def each_block(blocks: DataFrame, work: Callable[[int, pa.RecordBatch, dict], Iterator[pa.RecordBatch]], schema, answers: Sequence[str] = ()) -> DataFrame:
    """``work(block number, its documents, answers by name)`` for every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from work(row["block"], unpack_batch(row["payload"]), {a: row[a] or [] for a in answers})

    return blocks.select("block", "payload", *answers).mapInArrow(run, schema)


def questions(block: int, keys: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int64()), pa.array([block] * len(keys), pa.int64()), pa.array([b for _, b in keys], pa.binary())], ["range", "block", "keys"])


QUESTION = "range long, block long, keys binary"
ANSWER = "range long, block long, bits binary"


def gathered(answers: DataFrame, name: str) -> DataFrame:
    """One row per block: the answers of all ranges in order."""
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "bits"))).alias(name))


def with_answers(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """``blocks`` with a column of answers per name (null where a block got none)."""
    for name, table in answers.items():
        blocks = blocks.join(table, "block", "left")
    return blocks


def bits_by_range(answer: list[dict], ranges: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The answered bits of a block's sorted keys, False for ranges that did not answer."""
    out = np.zeros(int(sizes.sum()), bool)
    at = dict(zip(ranges.tolist(), zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist())))
    for row in answer:
        start, n = at[row["range"]]
        out[start: start + n] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=n)
    return out


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first index, value, length) of the runs of a sorted array."""
    if not len(values):
        return np.zeros(0, np.int64), values, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, values[first], np.diff(np.append(first, len(values)))


class Sketch:
    """A count-min sketch of ``rows`` x 2**``bits`` cells, cut into ranges of 2**RANGE_BITS cells."""

    RANGE_BITS = 20

    def __init__(self, items: int, rows: int, load: float):
        """Wide enough for ``load`` items a cell, whatever their number: it lives in ranges, not in one memory."""
        self.rows = rows
        self.bits = max(self.RANGE_BITS, int(np.ceil(np.log2(max(1.0, items / load)))))

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        seeded = mix64(hashes + np.uint64((2 * row + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        return seeded >> np.uint64(64 - self.bits)

    def partial(self, hashes: np.ndarray) -> list[tuple[int, bytes]]:
        """The block's partial sketch: per range its cells, and which of them it counts at least twice."""
        out = []
        per_row = 1 << (self.bits - self.RANGE_BITS)
        for row in range(self.rows):
            cells, counts = np.unique(self.cells(hashes, row), return_counts=True)
            first, ranges, sizes = runs(cells >> np.uint64(self.RANGE_BITS))
            low = (cells & np.uint64((1 << self.RANGE_BITS) - 1)).astype(np.uint32)
            twice = counts > 1
            for a, r, n in zip(first.tolist(), ranges.tolist(), sizes.tolist()):
                steps = np.diff(low[a: a + n], prepend=np.uint32(0)).astype("<u4")
                planes = steps.view(np.uint8).reshape(-1, 4).T.copy()  # the high bytes are nearly all zero
                out.append((row * per_row + int(r), squeeze(np.array([n], "<u4"), planes, np.packbits(twice[a: a + n]))))
        return out

    def estimates(self, hashes: np.ndarray, answer: list[dict]) -> np.ndarray:
        """Per item: does the estimate (the least of the rows) reach the count asked for?"""
        out = np.ones(len(hashes), bool)
        per_row = 1 << (self.bits - self.RANGE_BITS)
        by_row = [[a for a in answer if a["range"] // per_row == row] for row in range(self.rows)]
        for row in range(self.rows):
            cells, inverse = np.unique(self.cells(hashes, row), return_inverse=True)
            _, ranges, sizes = runs(cells >> np.uint64(self.RANGE_BITS))
            out &= bits_by_range(by_row[row], ranges.astype(np.int64) + row * per_row, sizes)[inverse]
        return out


def merge_group(group: pd.DataFrame) -> pd.DataFrame:
    """Answers of one range to the partial sketches of all blocks: cells whose merged count is two or more."""
    total = np.zeros(1 << Sketch.RANGE_BITS, np.uint8)
    parts = []
    for blob in group["keys"]:
        raw = expand(blob)
        n = int(np.frombuffer(raw[:4], "<u4")[0])
        low = np.cumsum(np.frombuffer(raw[4: 4 + 4 * n], np.uint8).reshape(4, n).T.copy().view("<u4").ravel(), dtype=np.uint64)
        twice = np.unpackbits(np.frombuffer(raw[4 + 4 * n:], np.uint8), count=n)
        total[low] = np.minimum(total[low] + 1 + twice, 2)
        parts.append(low)
    bits = [np.packbits(total[low] >= 2).tobytes() for low in parts]
    some = [any(b) for b in bits]
    return pd.DataFrame({"range": group["range"], "block": group["block"], "bits": bits})[some]


def merge_sketches(asked: DataFrame) -> DataFrame:
    return asked.groupBy("range").applyInPandas(merge_group, ANSWER)


def planes(values: np.ndarray) -> np.ndarray:
    """32-bit numbers byte by byte, all lowest bytes first: the high ones are nearly all zero."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy()


def unplaned(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T.copy().view("<u4").ravel()


class LevelSketch(Sketch):
    """A sketch of one row of cells whose answers are levels: floor(log2) of a cell's merged count, 0 where it is
    one.  All blocks get the same level for the same item."""

    def __init__(self, items: int, load: float):
        super().__init__(items, 1, load)

    def partial(self, hashes: np.ndarray) -> list[tuple[int, bytes]]:
        """The block's partial sketch: per range its cells and their counts."""
        cells, counts = np.unique(self.cells(hashes, 0), return_counts=True)
        low = (cells & np.uint64((1 << self.RANGE_BITS) - 1)).astype(np.uint32)
        return [(int(r), squeeze(np.array([n], "<u4"), planes(np.diff(low[a: a + n], prepend=np.uint32(0))), planes(counts[a: a + n])))
                for a, r, n in zip(*(x.tolist() for x in runs(cells >> np.uint64(self.RANGE_BITS))))]

    def levels(self, hashes: np.ndarray, answer: list[dict]) -> np.ndarray:
        """Per item its level; ranges without an answer have level 0 only."""
        cells, inverse = np.unique(self.cells(hashes, 0), return_inverse=True)
        out = np.zeros(len(cells), np.uint8)
        at = {r: (a, n) for a, r, n in zip(*(x.tolist() for x in runs(cells >> np.uint64(self.RANGE_BITS))))}
        for row in answer:
            a, n = at[row["range"]]
            out[a: a + n] = np.frombuffer(expand(row["bits"]), np.uint8, n)
        return out[inverse]


def level_group(group: pd.DataFrame) -> pd.DataFrame:
    """Answers of one range to the partial ``LevelSketch`` of all blocks."""
    total = np.zeros(1 << Sketch.RANGE_BITS, np.int64)
    parts = []
    for blob in group["keys"]:
        raw = expand(blob)
        n = int(np.frombuffer(raw[:4], "<u4")[0])
        low = np.cumsum(unplaned(raw, n, 4), dtype=np.uint64)
        total[low] += unplaned(raw, n, 4 + 4 * n)
        parts.append(low)
    level = (np.frexp(np.maximum(total, 1).astype(np.float64))[1] - 1).astype(np.uint8)
    found = [level[low] for low in parts]
    some = [bool(x.any()) for x in found]
    return pd.DataFrame({"range": group["range"], "block": group["block"], "bits": [squeeze(x) for x in found]})[some]


def merge_levels(asked: DataFrame) -> DataFrame:
    return asked.groupBy("range").applyInPandas(level_group, ANSWER)


class Keys:
    """A block's distinct 128-bit keys, sorted, each with its least place (number, position)."""

    def __init__(self, high: np.ndarray, low: np.ndarray, number: np.ndarray, position: np.ndarray, range_bits: int):
        order = np.lexsort((position, number, low, high))
        h, lo = high[order], low[order]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
        which = np.cumsum(new) - 1
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = which
        head = order[new]
        self.high, self.low, self.number, self.position = high[head], low[head], number[head], position[head]
        self.range = (self.high >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(head), np.int64)
        self.first, self.ranges, self.sizes = runs(self.range)

    def packed(self) -> list[tuple[int, bytes]]:
        return [(int(r), squeeze(np.array([n], "<u4"), self.high[a: a + n], self.low[a: a + n], self.number[a: a + n].astype("<i8"), self.position[a: a + n].astype("<u4")))
                for a, r, n in zip(self.first.tolist(), self.ranges.tolist(), self.sizes.tolist())]

    def elsewhere_earlier(self, answer: list[dict]) -> np.ndarray:
        """Per input key: does another block hold it at an earlier place?"""
        return bits_by_range(answer, self.ranges, self.sizes)[self.inverse]


def first_group(group: pd.DataFrame) -> pd.DataFrame:
    """Answers of one range to packed ``Keys``: keys that some block holds at an earlier place (number, position)."""
    highs, lows, numbers, positions, sizes = [], [], [], [], []
    for blob in group["keys"]:
        raw = expand(blob)
        n = int(np.frombuffer(raw[:4], "<u4")[0])
        highs.append(np.frombuffer(raw, "<u8", n, 4))
        lows.append(np.frombuffer(raw, "<u8", n, 4 + 8 * n))
        numbers.append(np.frombuffer(raw, "<i8", n, 4 + 16 * n))
        positions.append(np.frombuffer(raw, "<u4", n, 4 + 24 * n))
        sizes.append(n)
    high = np.concatenate(highs)
    later = np.zeros(len(high), bool)
    order = np.argsort(high, kind="stable")
    h = high[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    some = order[same[1:] | same[:-1]]  # keys that more than one block sent
    if len(some):
        low, number, position = (np.concatenate(x)[some] for x in (lows, numbers, positions))
        by = np.lexsort((position, number, low, high[some]))
        k, lo, nu, po = high[some][by], low[by], number[by], position[by]
        new = np.ones(len(by), bool)
        new[1:] = (k[1:] != k[:-1]) | (lo[1:] != lo[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later[some[by]] = (nu != nu[head]) | (po != po[head])
    cut = np.split(later, np.cumsum(sizes)[:-1])
    keep = [bool(c.any()) for c in cut]
    return pd.DataFrame({"range": group["range"], "block": group["block"], "bits": [np.packbits(c).tobytes() for c in cut]})[keep]


def find_first(asked: DataFrame) -> DataFrame:
    return asked.groupBy("range").applyInPandas(first_group, ANSWER)


def range_bits_for(keys: float, each: int = 1 << 20) -> int:
    """So many key ranges (a power of two) that one holds about ``each`` keys, however many there are."""
    return max(0, int(np.ceil(np.log2(max(1.0, keys / each)))))
