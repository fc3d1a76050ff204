"""Order MinHash fingerprints: likeness that follows edit distance.

The k-mers of a text's code points are numbered by occurrence, so a repeated k-mer counts as often
as it occurs.  One hash deals the numbered k-mers to bins; each bin keeps its few smallest, puts
them in text order and hashes the tuple: the signature changes when content or order changes.  An
empty bin takes its next filled neighbour's tuple (marked by the distance).  Two fingerprints'
likeness is their share of equal components, 0 to 1.

A text shorter than k is one k-mer.  Null text counts as empty; the empty text's fingerprint is the
empty string, like 1 to another empty one and 0 to anything else.  Equal texts have equal
fingerprints.  Rows are independent; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.llm.common import NULL_ID, byte_slices, id_numbers, mix64, shuffle_partitions, utf8
from raresight.llm.pretokens import codepoints

K, BINS, TUPLE = 8, 64, 2  # code points of a k-mer; components; k-mers of a component
BIN_BITS = 6
DIGITS = 4  # hex digits of a component
ODD = np.uint64(0x9E3779B97F4A7C15)


def numbered(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mer, position, occurrence): equal k-mers next to each other in text order, numbered from 0.

    K-mer and position are sorted in one word.  The position takes the hash's low bits there, so neighbours
    are compared by whole hashes: how a k-mer is numbered and hashed never depends on the text's length."""
    n = len(kmers)
    place_mask = (np.uint64(1) << np.uint64((n - 1).bit_length())) - np.uint64(1)
    high = kmers & ~place_mask
    keys = high | np.arange(n, dtype=np.uint64)
    keys.sort()
    place = (keys & place_mask).astype(np.int64)
    kmer = kmers[place]
    new = np.ones(n, bool)
    new[1:] = kmer[1:] != kmer[:-1]
    if (high[place][1:] == high[place][:-1])[new[1:]].any():  # different k-mers share the high bits
        place = np.argsort(kmers, kind="stable")
        kmer = kmers[place]
        new[1:] = kmer[1:] != kmer[:-1]
    index = np.arange(n)
    return kmer, place, index - np.maximum.accumulate(np.where(new, index, 0))


def components(points: np.ndarray) -> np.ndarray:
    """The signature of one non-empty text as BINS 16-bit numbers."""
    k = min(K, len(points))
    n = len(points) - k + 1
    value = mix64(points.astype(np.uint64) + np.uint64(1))
    hashed = value[:n].copy()
    for j in range(1, k):
        hashed *= ODD
        hashed += value[j: n + j]
    kmer, place, occurrence = numbered(mix64(hashed))
    mixed = mix64(kmer + occurrence.astype(np.uint64) * ODD)
    rest = mixed << np.uint64(BIN_BITS)
    share = 16 * BINS / n  # the smallest of each bin are among the small values; all are looked at when too few are
    while True:
        some = np.arange(n) if share >= 1 else np.flatnonzero(rest < np.uint64(int(share * 2.0 ** 64)))
        chosen = some[np.argsort(mixed[some], kind="stable")]
        u = mixed[chosen]
        first = np.searchsorted(u >> np.uint64(64 - BIN_BITS), np.arange(BINS + 1, dtype=np.uint64))
        filled = np.diff(first)
        if share >= 1 or (filled >= TUPLE).all():
            break
        share = 1.0
    out = np.zeros(BINS, np.uint64)
    pairs = np.flatnonzero(filled >= TUPLE)
    at = first[pairs][:, None] + np.arange(TUPLE)
    by_place = np.argsort(place[chosen[at]], axis=1)
    parts = np.take_along_axis(u[at], by_place, axis=1)
    tuple_hash = parts[:, 0]
    for j in range(1, TUPLE):
        tuple_hash = mix64(tuple_hash) + parts[:, j]
    out[pairs] = mix64(tuple_hash)
    single = np.flatnonzero((filled > 0) & (filled < TUPLE))
    out[single] = mix64(u[first[single]] + ODD)
    if (filled == 0).any():
        have = np.flatnonzero(filled)
        ahead = have[np.searchsorted(have, np.arange(BINS)) % len(have)]
        distance = (ahead - np.arange(BINS)) % BINS
        out = mix64(out[ahead] + distance.astype(np.uint64) * ODD)
    return (out >> np.uint64(48)).astype(">u2")


def fingerprints(docs: DataFrame, columns: Sequence[str], names: Sequence[str], keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, and the fingerprint of each of ``columns`` under the name in ``names``."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.StringType(), False) for n in names])
    inner = [f"__text{i}" for i in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, inner[0]):
            out = []
            for c in inner:
                data, offsets = utf8(batch.column(c))
                lead, points = codepoints(data)
                cut = np.searchsorted(lead, offsets).tolist()
                out.append(pa.array([components(points[a:b]).tobytes().hex() if b > a else "" for a, b in zip(cut, cut[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], [*keep, *names])

    return docs.select(*keep, *(docs[c].alias(i) for c, i in zip(columns, inner))).mapInArrow(run, schema)


def likeness(a: str, b: str) -> F.Column:
    """Share of equal components of two fingerprint columns."""
    same = F.expr(f"aggregate(sequence(0, {BINS - 1}), 0, (n, i) -> n + if(substring({a}, i * {DIGITS} + 1, {DIGITS}) = substring({b}, i * {DIGITS} + 1, {DIGITS}), 1, 0))")
    return F.when((F.col(a) == "") | (F.col(b) == ""), (F.col(a) == F.col(b)).cast("double")).otherwise(same / float(BINS))


def with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(doc_id, text, next_text): the text of the next document by ascending doc_id (equal ids by text, null ids
    first); the last document is followed by the first.  Null texts come out empty.

    One shuffle: ids are cut into ranges, and the first document of each range is copied to the
    range before it.  Only the ranges' bounds and first ids pass the driver.
    """
    partitions = partitions or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id").filter("doc_id is not null")
    ranges = 4 * partitions
    bounds = np.array(sorted(set(int(x) for x in ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)))), np.int64)

    @F.arrow_udf("long")  # null ids are a range of their own, the first
    def range_of(x: pa.Array) -> pa.Array:
        return pa.array(np.where(x.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(bounds, id_numbers(x), side="right") + 1), pa.int64())

    cut = rows.withColumn("range", range_of("doc_id"))
    firsts = cut.groupBy("range").agg(F.min("doc_id").alias("doc_id")).orderBy("range").collect()  # one row per range
    first_ids = np.array([NULL_ID if r["doc_id"] is None else r["doc_id"] for r in firsts], np.int64)  # ascending, as the ranges are
    range_ahead = np.array([firsts[i - 1]["range"] for i in range(len(firsts))], np.int64)

    @F.arrow_udf("long")
    def range_before(x: pa.Array) -> pa.Array:
        ids = id_numbers(x)
        at = np.minimum(np.searchsorted(first_ids, ids), len(first_ids) - 1)
        return pa.array(range_ahead[at], pa.int64(), mask=first_ids[at] != ids)

    guests = cut.withColumn("guest", F.lit(1)).withColumn("range", range_before("doc_id")).filter("range is not null")
    dealt = (cut.withColumn("guest", F.lit(0)).unionByName(guests).repartition(partitions, "range")
             .sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, out = None, []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))], ["doc_id", "text", "next_text"])

        for batch in byte_slices(batches, "text"):
            for r in batch.to_pylist():
                if pending is not None and pending["range"] == r["range"]:
                    out.append((pending["doc_id"], pending["text"], r["text"]))
                    pending = None if r["guest"] else r
                elif not r["guest"]:
                    pending = r
            if out:
                yield batch_of(out)
                out = []

    return dealt.mapInArrow(run, "doc_id long, text string, next_text string")
