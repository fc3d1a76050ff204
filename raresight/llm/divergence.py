"""Source divergence audit: which sources of a language use its words differently.

In-mapper stripes: a task codes the words of some megabytes of whole documents, sorts the codes and folds them into
stripes, language and term -> (document frequency, occurrences by source).  The tasks' stripes are
merged by key; a merged stripe that reaches ``min_documents`` is a kept term.  From the merged
stripes come each source's most divergent terms against its language, and every pair's divergence.

With V kept terms of a language and N occurrences of them in a group, a term that occurs n times has
p = 1 + floor(10^9 (n + 2) / (N + 2 V)); p against q diverges by floor((p - q)^2 / (p + q)).  All
of it is whole numbers.

A pair's sum runs over all kept terms, most of which neither source holds.  It is put together from what
occurs: with p0 and q0 for n = 0, the sum is (V - |a| - |b|) f(p0, q0), plus f(p, q0) over the terms of a,
plus f(p0, q) over the terms of b (both from the few different p of a source), plus
f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) over the terms of both.  A task adds the last part up over
its stripes before anything is emitted, in tiles of bounded size.

Null text, language and source count as ''.  A language without kept terms has pairs of value 0;
a group without terms is still a group.  Repeated rows are documents of their own.  Ties are ranked
by the item's bytes.  An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raresight.llm.common import SLICE_BYTES, byte_slices, cut_bytes, shuffle_partitions, utf8, written

# a byte of a term, lower-cased (letters and all that is not ASCII); 0 for any other
LETTER = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
BETWEEN = re.compile(rb"[^A-Za-z\x80-\xff]")
FOLD_BYTES = 8 << 20  # text that a task folds at once; a longer document is counted in pieces of this size
TILE, TILES = 256, 64  # sources of one side of a tile of pairs; tiles that a task holds
PAIRS = 1 << 18  # pairs of cells worked on at once
SCALE = 10 ** 9

STRIPE = "lang string, term string, cells array<struct<source:string,docs:long,n:long>>"


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of texts one after another, coded, and each text's number of them."""
    lower = LETTER[data]
    inside = lower > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]  # no term crosses texts
    letters, starts = lower[inside], np.flatnonzero(begins[inside])
    ends = np.append(starts, len(letters)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(letters))
    return found.dictionary_encode(), np.diff(np.searchsorted(np.flatnonzero(begins), offsets))


def counted(text: pa.Array, number: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, and for each term and text that holds it, in this order: the term's place, the text's ``number``, the occurrences."""
    coded, many = words(*utf8(text))
    key = np.sort(coded.indices.to_numpy().astype(np.int64) * len(text) + np.repeat(number, many))
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return coded.dictionary, key[at] // len(text), key[at] % len(text), np.diff(np.append(at, len(key)))


def counted_long(text: bytes, size: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The same of one long text, by pieces."""
    parts = []
    for piece in cut_bytes(text, BETWEEN, size):
        terms, _, _, n = counted(pa.array([piece], pa.binary()), np.zeros(1, np.int64))
        parts.append(pa.table({"term": terms, "n": n}))
    whole = pa.concat_tables(parts).group_by("term").aggregate([("n", "sum")]).combine_chunks()
    terms = pa.concat_arrays(whole.column("term").chunks)
    return terms, np.arange(len(terms)), np.zeros(len(terms), np.int64), whole.column("n_sum").to_numpy()


def striped(batch: pa.RecordBatch, limit: int) -> pa.RecordBatch:
    """The stripes of a batch of documents; one that is longer than ``limit`` comes alone."""
    named = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
    groups = sorted(set(named))
    place = {g: i for i, g in enumerate(groups)}
    group = np.array([place[g] for g in named], np.int64)
    # documents numbered by group: one sort brings a term's languages, sources and documents together
    order = np.argsort(group, kind="stable")
    number = np.empty(len(group), np.int64)
    number[order] = np.arange(len(group))
    data, _ = utf8(batch.column("text"))
    if batch.num_rows == 1 and len(data) > limit:
        terms, term, document, n = counted_long(data.tobytes(), limit)
    else:
        terms, term, document, n = counted(batch.column("text"), number)
    own = group[order][document]
    langs: dict[str, int] = {}
    lang = np.array([langs.setdefault(g[0], len(langs)) for g in groups])[own]
    stripe = (np.diff(term, prepend=-1) != 0) | (np.diff(lang, prepend=-1) != 0)
    cell = np.flatnonzero(stripe | (np.diff(own, prepend=-1) != 0))
    docs, n = np.diff(np.append(cell, len(term))), np.add.reduceat(n, cell) if len(cell) else n
    stripe = np.flatnonzero(stripe[cell])
    sources = pa.array([g[1] for g in groups], pa.string()).take(pa.array(own[cell]))
    cells = pa.StructArray.from_arrays([sources, pa.array(docs, pa.int64()), pa.array(n, pa.int64())], ["source", "docs", "n"])
    first = cell[stripe]
    return pa.RecordBatch.from_arrays([pa.array([g[0] for g in groups], pa.string()).take(pa.array(own[first])), terms.cast(pa.string()).take(pa.array(term[first])),
                                       pa.ListArray.from_arrays(pa.array(np.append(stripe, len(cell)), pa.int32()), cells)], ["lang", "term", "cells"])


def fold(batches: Iterator[pa.RecordBatch], limit: int = FOLD_BYTES) -> Iterator[pa.RecordBatch]:
    """The stripes of the documents, about ``limit`` bytes of them at a time."""
    held, size = [], 0

    def spilled() -> Iterator[pa.RecordBatch]:
        for whole in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield striped(whole, limit)

    for batch in byte_slices(batches, "text", min(limit, SLICE_BYTES)):
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        long = np.flatnonzero(sizes > limit)
        cuts = np.unique([0, *long, *(long + 1), batch.num_rows]).tolist()
        for u, v in zip(cuts, cuts[1:]):
            piece = batch.slice(u, v - u)
            if held and size + piece.nbytes > limit:
                yield from spilled()
                held, size = [], 0
            held.append(piece)
            size += piece.nbytes  # with the names, so that empty texts count too
    if held:
        yield from spilled()


def folded(docs: DataFrame, limit: int = FOLD_BYTES) -> DataFrame:
    """The tasks' stripes (``lang``, ``term``, ``cells``: documents and occurrences by source): a term has a row for each fold that met it."""
    return docs.select("lang", "source", "text").mapInArrow(lambda batches: fold(batches, limit), STRIPE)


def merged(stripes: DataFrame, min_documents: int) -> DataFrame:
    """One row per kept term: lang, term, n (occurrences in the language), cells."""
    # dealt once by (lang, term): the sums below need no other exchange
    dealt = stripes.repartition(shuffle_partitions(stripes.sparkSession), "lang", "term").select("lang", "term", F.inline("cells"))
    cells = dealt.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    whole = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return whole.filter(F.col("docs") >= min_documents).drop("docs")


def share(n: Column, total: str, terms: str) -> Column:
    """p of ``n`` occurrences; decimals, as 10^9 n passes a long."""
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + 2), F.col(total).cast("decimal(20,0)") + 2 * F.col(terms).cast("decimal(20,0)"))
    return whole + 1


def apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def numbered(column: pa.Array, known: dict[str, int]) -> np.ndarray:
    """The number of each value; new values are numbered on."""
    coded = column.dictionary_encode()
    return np.array([known.setdefault(v, len(known)) for v in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both ways of each pair of sources with its sum over the terms of a task that both hold."""
    sums: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}  # (language, tile, tile) -> values, which pairs were met
    langs: dict[str, int] = {}
    sources: dict[str, int] = {}
    within: dict[int, dict[int, int]] = {}  # language -> source -> its number there

    def emitted() -> Iterator[pa.RecordBatch]:
        spoken, named = list(langs), pa.array(list(sources), pa.string())
        for (lang, i, j), (value, met) in sums.items():
            a, b = np.nonzero(met)
            names = named.take(pa.array(list(within[lang]), pa.int64()))
            one, other, value = names.take(pa.array(a + i * TILE)), names.take(pa.array(b + j * TILE)), pa.array(value[a, b])
            for x, y in ((one, other), (other, one)):
                yield pa.RecordBatch.from_arrays([pa.array([spoken[lang]] * len(a), pa.string()), x, y, value], ["lang", "a", "b", "value"])
        sums.clear()

    for batch in batches:
        cells, lists = batch.column("cells").flatten(), batch.column("cells")
        if not len(cells):
            continue
        term = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        lang, source = numbered(batch.column("lang"), langs)[term], numbered(cells.field("source"), sources)
        groups, group = np.unique(lang << 32 | source, return_inverse=True)
        known = [within.setdefault(g >> 32, {}) for g in groups.tolist()]
        source = np.array([k.setdefault(g & 0xFFFFFFFF, len(k)) for k, g in zip(known, groups.tolist())])[group]
        order = np.lexsort((source, term))  # of two cells of a term, the first has the smaller number
        term, lang, source = term[order], lang[order], source[order]
        p, p0 = (cells.field(c).to_numpy(zero_copy_only=False)[order] for c in ("p", "p0"))
        after = np.searchsorted(term, term, side="right") - np.arange(len(term)) - 1  # cells of the term behind this one
        part = (np.cumsum(after) - after) // PAIRS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(term)]
        for begin, end in zip(cuts, cuts[1:]):
            many = after[begin:end]
            a = np.repeat(np.arange(begin, end), many)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
            tile = np.stack([lang[a], source[a] // TILE, source[b] // TILE])
            turn = np.lexsort(tile)
            a, b, tile = a[turn], b[turn], tile[:, turn]
            x, x0, y, y0 = p[a], p0[a], p[b], p0[b]
            gained = f(x, y) - f(x, y0) - f(x0, y) + f(x0, y0)
            spot = source[a] % TILE * TILE + source[b] % TILE
            bounds = [0, *(np.flatnonzero((np.diff(tile) != 0).any(axis=0)) + 1).tolist(), len(a)]
            for u, v in zip(bounds, bounds[1:]):
                if u == v:
                    continue
                value, met = sums.setdefault(tuple(tile[:, u].tolist()), (np.zeros((TILE, TILE), np.int64), np.zeros((TILE, TILE), bool)))
                np.add.at(value.reshape(-1), spot[u:v], gained[u:v])
                met.reshape(-1)[spot[u:v]] = True
                if len(sums) > TILES:
                    yield from emitted()
    yield from emitted()


def both_held(stripes: DataFrame) -> DataFrame:
    """(lang, a, b, value): the sum over terms that both hold, added up within each task before it is shuffled.

    ``stripes``: lang, cells (source, p, p0)."""

    found = stripes.select("lang", "cells").mapInArrow(pair_sums, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_documents: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank).  Part ``pair``: every other source of the language; part ``term``: the
    ``top`` terms whose share in the source exceeds the language's by most."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    stripes = written(merged(folded(named), min_documents), "divergence-stripes")
    cells = stripes.select("lang", "term", F.col("n").alias("n_lang"), F.inline("cells"))

    langs = stripes.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("total_lang"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    groups = (named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "held", "v", "total_lang")]))
    # one row per group, sized by its files: broadcast where it is small, joined by shuffling beyond
    groups = written(groups.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), "total", "v"))), "divergence-groups")
    shares = written(cells.join(groups, ["lang", "source"]).select("lang", "term", "source", share(F.col("n"), "total", "v").alias("p"), "p0", share(F.col("n_lang"), "total_lang", "v").alias("q")), "divergence-shares")

    by_value = [F.desc("value"), F.asc("item")]
    # count > 0 holds by itself; the first ranks of each task are cut before the shuffle
    terms = (shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value"))
             .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*by_value))).filter(F.col("rank") <= top))

    other = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("q0"), F.col("held").alias("held_b"))
    neither = (groups.select("lang", F.col("source").alias("a"), "p0", "held", "v").join(other, "lang").filter("a <> b")
               .select("lang", "a", "b", F.coalesce((F.col("v") - F.col("held") - F.col("held_b")) * apart("p0", "q0"), F.lit(0)).alias("value")))
    different = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("n"))
    one = (different.join(other, "lang").filter("a <> b").select("lang", "a", "b", (F.col("n") * apart("p", "q0")).alias("value"))
           .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = both_held(shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("cells")))
    sums = neither.union(one).union(one.select("lang", "b", "a", "value")).union(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = (sums.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
             .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*by_value))))
    return terms.unionByName(pairs).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
