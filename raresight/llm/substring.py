"""Substring dedup: remove words covered by a window of words that also starts earlier.

A window is ``window`` consecutive words of one document.  Its anchor is the smallest hash among its
runs of ``run`` words: equal windows have equal anchors, and anchors are much fewer than windows.  A
count-min sketch of the anchors (one partial sketch per block, merged) estimates how often each
occurs; an estimate is never too low, so a window whose anchor is estimated once is unique.  A
second round groups the windows estimated repeated exactly, by 128-bit hashes, and finds for each
block the windows that start earlier elsewhere.  Windows are judged on the input.

Order is (doc_id, position), a null doc_id first.  Null text has no words.  Rows that share a
doc_id count as the same document: a word at the same position of both is at the same place, and
neither is earlier.  Documents with fewer words than a window lose nothing; an empty table gives an
empty table; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.llm import blocks as B
from raresight.llm.common import id_numbers, mix64, utf8, word_hashes, word_spans, written

MULTIPLIERS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
WORD_BYTES = 6  # about; only sizes the sketch and the ranges


def sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Least (or greatest) of every ``size`` neighbours, by doubling."""
    pick = np.minimum if least else np.maximum
    width, out = 1, values
    while width * 2 <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def run_hashes(words: np.ndarray, size: int, multiplier: np.uint64) -> np.ndarray:
    """A 64-bit hash of every ``size`` neighbouring words."""
    n = len(words) - size + 1
    value = words[:n].copy()
    for j in range(1, size):
        value *= multiplier
        value += words[j: n + j]
    return mix64(value)


class Windows:
    """Words, windows and anchors of one block."""

    def __init__(self, batch: pa.RecordBatch, window: int, run: int):
        self.data, self.offsets = utf8(batch.column("__text"))
        self.first, self.end, self.row = word_spans(self.data, self.offsets)
        self.window = window
        words = word_hashes(self.data, self.first, self.end)
        n = len(words)
        self.start_of_row = np.searchsorted(self.row, np.arange(batch.num_rows + 1))
        if n < window:
            self.at, self.words = np.zeros(0, np.int64), words
            self.anchor = self.anchors = np.zeros(0, np.uint64)
            return
        self.words = words
        valid = self.row[window - 1:] == self.row[: n - window + 1]
        runs = run_hashes(words, run, MULTIPLIERS[0])
        among = window - run + 1
        anchor = sliding(runs, among, True)
        self.at = np.flatnonzero(valid)
        self.anchor = anchor[self.at]
        # a run is an anchor when some window over it has it as its least: each place counts once
        of_window = np.where(valid, anchor, np.uint64(0))
        edge = np.zeros(among - 1, np.uint64)
        greatest = sliding(np.concatenate([edge, of_window, edge]), among, False)
        self.anchors = runs[greatest == runs]

    def keys(self, chosen: np.ndarray, numbers: np.ndarray, range_bits: int) -> tuple[B.Keys, np.ndarray, np.ndarray]:
        """(keys of the windows at ``chosen``, their document numbers, their positions)."""
        at = self.at[chosen]
        high, low = (mix64(run_hashes(self.words, self.window, m)[at] + np.uint64(self.window)) if len(at) else np.zeros(0, np.uint64) for m in MULTIPLIERS)
        number, position = numbers[self.row[at]], at - self.start_of_row[self.row[at]]
        return B.Keys(high, low, number, position, range_bits), number, position


def dedup_substrings(docs: DataFrame, window: int = 20, run: int = 10, keep: Sequence[str] = ("doc_id",), text: str = "text",
                     layout: bool = False, block_bytes: int = B.SLICE_BYTES) -> DataFrame:
    """``keep`` columns, n_words, n_removed and ``kept_text``: the kept words joined by one space, or, with
    ``layout``, the text without the removed words and the white space after them."""
    blocks = B.block_table(docs.select(*keep, F.col("doc_id").cast("long").alias("__id"), F.col(text).alias("__text")), "__text", block_bytes)
    words = B.total_bytes(blocks) / WORD_BYTES
    # about two anchors per (window - run + 2) words; a quarter of a cell's worth each
    sketch = B.Sketch(int(2 * words / (window - run + 2)), rows=2, load=0.25)
    range_bits = B.range_bits_for(words / 2)

    def ask_sketch(block, batch, _):
        found = sketch.partial(Windows(batch, window, run).anchors)
        if found:
            yield B.questions(block, found)

    estimated = written(B.gathered(B.merge_sketches(B.each_block(blocks, ask_sketch, B.QUESTION)), "estimated"), "substring-estimates")

    def ask_first(block, batch, answers):
        w = Windows(batch, window, run)
        chosen = np.flatnonzero(sketch.estimates(w.anchor, answers["estimated"]))
        found = w.keys(chosen, id_numbers(batch.column("__id")), range_bits)[0].packed()
        if found:
            yield B.questions(block, found)

    known = B.with_answers(blocks, estimated=estimated)
    earlier = written(B.gathered(B.find_first(B.each_block(known, ask_first, B.QUESTION, ("estimated",))), "earlier"), "substring-earlier")
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def remove(block, batch, answers):
        w = Windows(batch, window, run)
        chosen = np.flatnonzero(sketch.estimates(w.anchor, answers["estimated"]))
        keys, number, position = w.keys(chosen, id_numbers(batch.column("__id")), range_bits)
        again = keys.elsewhere_earlier(answers["earlier"])
        own = keys.inverse
        again |= (number != keys.number[own]) | (position != keys.position[own])  # not the block's own first
        change = np.zeros(len(w.words) + window + 1, np.int64)
        hit = w.at[chosen][again]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + window, -1)
        gone = np.cumsum(change)[: len(w.words)] > 0
        rows = batch.num_rows
        kept = layout_texts(w, gone, rows) if layout else joined_texts(w, gone, rows)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.bincount(w.row, minlength=rows), pa.int64()),
                                          pa.array(np.bincount(w.row[gone], minlength=rows), pa.int64()), kept], schema.names)

    return B.each_block(B.with_answers(blocks, estimated=estimated, earlier=earlier), remove, schema, ("estimated", "earlier"))


def joined_texts(w: Windows, gone: np.ndarray, rows: int) -> pa.Array:
    """Kept words of each row, joined by one space."""
    first, length, row = w.first[~gone], (w.end - w.first)[~gone], w.row[~gone]
    size = length + 1  # a space after each word; a row's last one is cut off below
    ahead = np.cumsum(size) - size
    out = np.full(int(size.sum()), 0x20, np.uint8)
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[step + np.repeat(ahead, length)] = w.data[step + np.repeat(first, length)]
    ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(row, np.arange(rows + 1))]
    raw = out.tobytes()
    return pa.array([raw[a: max(a, b - 1)].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string())


def layout_texts(w: Windows, gone: np.ndarray, rows: int) -> pa.Array:
    """Each row's text without the removed words, each with the white space after it; null stays empty."""
    keep = np.ones(len(w.data), bool)
    for i in np.flatnonzero(gone).tolist():
        after = w.first[i + 1] if i + 1 < len(w.first) and w.row[i + 1] == w.row[i] else w.offsets[w.row[i] + 1]
        keep[w.first[i]: after] = False
    raw = w.data[keep].tobytes()
    ends = np.concatenate([[0], np.cumsum(keep)])[w.offsets].tolist()
    return pa.array([raw[a:b].decode() for a, b in zip(ends, ends[1:])], pa.string())


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
