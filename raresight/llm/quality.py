"""Quality rules whose thresholds follow the data.

Each document gets exact counts (words, code points in words, symbols, repeated lines, words in
repeated three-word windows).  The base rules are fixed.  The other thresholds come from quantile
sketches per language and source: counts of logarithmic buckets (relative error below 1 %), which
merge by addition, so the order of merging never changes a threshold.  A language and source mixes
its quantiles with its language's, by its number of documents against ``weight``, and the language
with the whole table's.  A document fails a rule when it lies beyond the outer quartile fence of its
group by more than the rule's tolerance; for repeated lines and words, which most documents lack,
beyond the fence and beyond the 0.99 quantile of the group's values above zero.

Null text has no words (and so fails the base rules); null language or source is a group of its
own; rows are judged one by one, so repeated rows get equal verdicts; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.llm.common import IS_SPACE, byte_slices, utf8, word_spans, written

SYMBOLS = "#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS.encode())] = True
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

GAMMA = 1.02  # ratio of neighbouring bucket bounds
# metric -> (expression, sides of the fence that are judged, tolerance beyond the fence)
METRICS = {
    "word_length": ("word_chars / n_words", ("low", "high"), 1.0),
    "symbols": ("n_symbols / n_words", ("high",), 0.1),
    "dup_lines": ("n_dup_lines / n_lines", ("high",), None),
    "repeats": ("n_repeat_words / n_words", ("high",), None),
}
FENCE = 3.0
COMMON = 0.99  # without a tolerance: what this share of the group's values above zero keeps within is accepted
WEIGHT = 20.0  # documents that the parent's quantiles count for


def exact_codes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal words get equal numbers, different words different ones."""
    length = end - first
    ahead = np.cumsum(length) - length
    source = np.repeat(first - ahead, length) + np.arange(int(length.sum()))
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    column = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[source])])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def repeated_words(codes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row: words that lie in a three-word window found at least twice in the row."""
    n = len(codes)
    if n < 3:
        return np.zeros(rows, np.int64)
    inside = row[2:] == row[:-2]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(rows, np.int64)
    width = int(codes.max()) + 1
    pair, _ = pd.factorize(codes[at] * width + codes[at + 1])
    triple, _ = pd.factorize(pair * width + codes[at + 2])
    own, _ = pd.factorize(triple * rows + row[at])
    twice = at[np.bincount(own)[own] > 1]
    hit = np.zeros(n, bool)
    for j in range(3):
        hit[twice + j] = True
    return np.bincount(row[hit], minlength=rows)


def repeated_lines(text: str) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier line)."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def counts(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the exact counts of ``text``."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType(), False) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "__text"):
            column = batch.column("__text")
            data, offsets = utf8(column)
            first, end, row = word_spans(data, offsets)
            rows = batch.num_rows

            def per_row(hits: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])[offsets])

            lines = np.array([repeated_lines(t or "") for t in column.to_pylist()], np.int64).reshape(rows, 2)
            repeats = repeated_words(exact_codes(data, first, end), row, rows) if len(first) else np.zeros(rows, np.int64)
            found = [np.bincount(row, minlength=rows), per_row(((data & 0xC0) != 0x80) & ~IS_SPACE[data]), per_row(IS_SYMBOL[data]), lines[:, 0], lines[:, 1], repeats]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x, pa.int64()) for x in found)], [*keep, *COUNTS])

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def thresholds(counted: DataFrame, by: Sequence[str], weight: float = WEIGHT) -> DataFrame:
    """One row per group of ``by``: ``<metric>_low`` and ``<metric>_high`` limits.

    A group of n documents takes n parts of its own quantiles and ``weight`` parts of its parent's, which are
    mixed in the same way, up to the whole table's: one rule at every size."""
    base = counted.filter(f"not ({BASE_FAILED})")
    step = float(np.log(GAMMA))
    # the sketch: one counter per group, metric and bucket; zero has a bucket of its own
    long = base.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(e).cast("double").alias("value")) for m, (e, _, _) in METRICS.items()])).alias("x")).select(
        *by, "x.metric", F.when(F.col("x.value") > 0, F.ceil(F.log("x.value") / step)).alias("bucket"))
    sketch = long.groupBy(*by, "metric", "bucket").agg(F.count("*").alias("n"))
    limits = None
    for level in range(len(by), -1, -1):  # group, then its parents, then the whole table
        keys = [*by[:level], "metric"]
        merged = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
        of_group = Window.partitionBy(*keys)
        ranked = merged.withColumns({"seen": F.sum("n").over(of_group.orderBy(F.col("bucket").asc_nulls_first())), "total": F.sum("n").over(of_group),
                                     "zeros": F.sum(F.when(F.col("bucket").isNull(), F.col("n")).otherwise(0)).over(of_group)})
        middle = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.exp((F.col("bucket") - 0.5) * step))
        common = F.col("bucket").isNotNull() & (F.col("seen") - F.col("zeros") >= COMMON * (F.col("total") - F.col("zeros")))
        quantiles = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *[F.min(F.when(F.col("seen") >= q * F.col("total"), middle)).alias(c) for c, q in (("q1", 0.25), ("q3", 0.75))],
                                              F.min(F.when(common, F.exp(F.col("bucket") * step))).alias("common"))  # its bucket's upper bound
        own = quantiles.groupBy(*by[:level]).agg(F.max("total").alias(f"n{level}"), *[
            F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}{level}") for m in METRICS for c in ("q1", "q3", "common")])
        if limits is None:
            limits = own
        else:
            extra = [c for c in own.columns if c not in by]
            if level:
                renamed = own.select(*[F.col(c).alias(f"__{c}{level}") for c in by[:level]], *extra)
                on = [F.col(c).eqNullSafe(F.col(f"__{c}{level}")) for c in by[:level]]
                limits = limits.join(renamed, on, "left").drop(*[f"__{c}{level}" for c in by[:level]])
            else:  # the whole table's quantiles are one row
                row = own.select(F.struct(*extra)).scalar()
                limits = limits.withColumns({c: row.getField(c) for c in extra})

    def mixed(name: str) -> F.Column:
        out = F.coalesce(F.col(f"{name}0"), F.lit(0.0))
        for level in range(1, len(by) + 1):
            n = F.col(f"n{level}")
            out = (n * F.coalesce(F.col(f"{name}{level}"), out) + weight * out) / (n + weight)
        return out

    out = []
    for m, (_, sides, tolerance) in METRICS.items():
        q1, q3 = mixed(f"{m}_q1"), mixed(f"{m}_q3")
        if "low" in sides:
            out.append((q1 - FENCE * (q3 - q1) - tolerance).alias(f"{m}_low"))
        fence = q3 + FENCE * (q3 - q1)
        out.append((F.greatest(fence, mixed(f"{m}_common")) if tolerance is None else fence + tolerance).alias(f"{m}_high"))
    return limits.select(*by, *out)


SMALL_TABLE = 50_000  # rows of fences that are broadcast; more are joined by shuffling


def verdicts(counted: DataFrame, fences: DataFrame, by: Sequence[str]) -> DataFrame:
    """``counted`` with base_failed and kept."""
    limits = fences.select(*[F.col(i).alias(f"{i}_") for i in by], *[c for c in fences.columns if c not in by])
    if fences.count() <= SMALL_TABLE:
        limits = F.broadcast(limits)
    inside = F.lit(True)
    for m, (expression, sides, _) in METRICS.items():
        for side in sides:
            value, limit = F.expr(expression), F.col(f"{m}_{side}")
            inside = inside & F.coalesce(value >= limit if side == "low" else value <= limit, F.lit(True))
    joined = counted.join(limits, [F.col(i).eqNullSafe(F.col(f"{i}_")) for i in by], "left")
    failed = F.expr(BASE_FAILED)
    return joined.select(*counted.columns, failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(inside).alias("kept"))


def judge(docs: DataFrame, keep: Sequence[str] = ("doc_id",), by: Sequence[str] = ("lang", "source"), weight: float = WEIGHT) -> DataFrame:
    """``keep`` columns, the counts, base_failed and kept."""
    inner = [f"__by{i}" for i in range(len(by))]
    named = docs.select(F.struct(*keep).alias("__row"), docs["text"], *[docs[c].alias(i) for c, i in zip(by, inner)])
    counted = written(counts(named, ["__row", *inner]), "quality-counts")
    fences = written(thresholds(counted, inner, weight), "quality-fences")
    return verdicts(counted, fences, inner).select("__row.*", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, by: Sequence[str] = ("lang", "source"), weight: float = WEIGHT) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.  The texts are counted twice (for the sketches, then
    for the verdict) so that they never move between machines."""
    inner = [f"__by{i}" for i in range(len(by))]
    bys = [docs[c].alias(i) for c, i in zip(by, inner)]
    fences = written(thresholds(counts(docs.select("text", *bys), inner), inner, weight), "quality-fences")
    counted = counts(docs.select(F.struct(*docs.columns).alias("__row"), "text", *bys), ["__row", *inner])
    return verdicts(counted, fences, inner).filter("kept").select("__row.*")
