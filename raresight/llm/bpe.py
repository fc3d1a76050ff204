"""Byte-level BPE encoding and decoding.

Pieces come from ``pretokens`` (class arrays and an associative scan, no regular expression);
each distinct piece is merged once per worker by pair ranks; the ids of a text are gathered from
the distinct pieces.  The byte offset of every id is kept, and decoding places each id's bytes at
its offset.

Null text counts as empty (no ids); a null list of ids decodes to null.  Rows are independent:
repeated rows give equal results, an empty table gives an empty table, and columns other than the
named ones are passed by unless ``keep`` names them.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from raresight.llm.common import byte_slices
from raresight.llm.pretokens import PieceIds, Pieces

LONG_PIECE = 64
DECODE_IDS = 1 << 19  # ids decoded at once; a longer document is decoded by itself


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbouring pair of lowest rank, leftmost first, until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return merge_long(piece, ranks)
    parts = [piece[i: i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over linked parts: n log n for a piece without a break."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that begins here; 0 once it is merged away
    before = list(range(-1, n - 1))

    def candidate(i: int):
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i: end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

    heap: list[tuple[int, int, int, int]] = []
    for i in range(n - 1):
        candidate(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or end[j] != k or not end[i]:
            continue  # one of the two parts has changed since
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        candidate(i)
        if before[i] >= 0:
            candidate(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i: end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """Ranks, the store of merged pieces, and the bytes of every id."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.pieces = PieceIds(lambda values: [merge_piece(v, self.ranks) for v in values])
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, ranks_path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and ``offsets`` (first byte of each id in the UTF-8 text)."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.ArrayType(T.IntegerType(), False), False) for c in ("ids", "offsets")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(ranks_path)
        for batch in byte_slices(batches, "__text"):
            ids, counts, _ = v.pieces.ids(Pieces(batch.column("__text")))
            length = v.length[ids]
            offset = np.cumsum(length) - length
            first = np.repeat(np.concatenate([[0], np.cumsum(counts)])[:-1], counts)
            offset -= offset[first] if len(offset) else 0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists(ids, counts), lists(offset, counts)], [*keep, "ids", "offsets"])

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """``keep`` columns and ``decoded`` (binary): every id's bytes at its offset."""
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(ranks_path)
        for whole in batches:
            sizes = pc.fill_null(whole.column("__ids").value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // DECODE_IDS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                batch, counts = whole.slice(a, b - a), sizes[a:b]
                column, places = batch.column("__ids"), batch.column("__offsets")
                token = column.flatten().to_numpy(zero_copy_only=False)
                place = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                last = np.cumsum(counts) - 1
                length = v.length[token]
                size = np.where(counts > 0, place[last] + length[last], 0) if len(token) else np.zeros(len(counts), np.int64)
                base = np.cumsum(size) - size
                target = np.repeat(place + np.repeat(base, counts) - (np.cumsum(length) - length), length)
                source = np.repeat(v.start[token] - (np.cumsum(length) - length), length)
                step = np.arange(len(source))
                out = np.zeros(int(size.sum()), np.uint8)
                out[target + step] = v.bytes[source + step]
                bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                decoded = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(out)])
                if column.null_count:
                    decoded = pc.if_else(column.is_valid(), decoded, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), decoded], [*keep, "decoded"])

    return encoded.select(*keep, encoded[ids].alias("__ids"), encoded[offsets].alias("__offsets")).mapInArrow(run, schema)
