"""Spelling variants: words one inserted, deleted or replaced code point apart, and the usual form of each.

Trie-node pair dictionary.  The prefixes of all words are the nodes of a trie, the suffixes those of a second
one of the reversed words, and every node has a number.  A word of length L makes the pairs

* (prefix node i, suffix node i) for i = 0..L: the word cut at i, and
* (prefix node i, suffix node i + 1) for i < L: the word with position i skipped.

Two words share a pair of the second kind exactly if they differ by one replaced position; a skipped pair equals
a cut pair exactly if the longer word loses that position to become the shorter.  Deleting any of a run
of equal letters gives the same word, so only a run's last position counts there: no neighbour is met
twice, and counts need no distinct.  A pair is met by one word per code point that can stand at the
skipped place and by one cut word, so a group is bounded by the alphabet, whatever the table's size.

Numbering without a join: the words are dealt by range and sorted, so a prefix is either found in one range only
(numbered there, next to its neighbours) or is a prefix of a bound between ranges (numbered from the bounds,
the same way in every task).  The bounds are the first ``CUT`` code points of a bounded sample of words.

Null text has no words; the edits' null doc_id reads as ''.  Repeated rows count again.  Ties go to the least word in
code-point order.  Words of any length are whole.  An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.llm.common import byte_slices, cut_bytes, shuffle_partitions, utf8, written

# Letters on UTF-8 bytes: a-z (once lower-cased) and U+00C0..U+00FF, which are C3 80..C3 BF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
BETWEEN = re.compile(rb"[^a-z\x80-\xff]")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORDS = 200_000  # different words that a task holds before it hands them on
SAMPLE, CUT = 64, 32  # sampled words per range; code points of a bound
SLICE = 1 << 16  # bytes of words handled at once
CUT_HERE, SKIP, SKIP_LAST = 2, 0, 1  # kinds of pairs; SKIP_LAST: the last position of a run of equal letters


def edited(run: bytes, salt: int, every: int) -> bytes:
    """``run``, without the code point that its checksum names if ``every`` divides the checksum."""
    h = zlib.crc32(run, salt)
    if h % every:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def counted(docs: DataFrame, min_length: int, edit_every: int | None, limit: int = WORDS) -> DataFrame:
    """(word, n) as the tasks folded them: a word has a row for each batch that met it."""

    def rows(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in byte_slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            for doc, a, b in zip(batch.column("doc").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                salt, own = zlib.crc32(f"{'' if doc is None else doc}:".encode()), Counter()
                for piece in cut_bytes(data[a:b].tobytes().translate(LOWER), BETWEEN):
                    own.update(RUN.findall(piece))
                for word, n in own.items():
                    if len(word) < min_length:
                        continue  # never more code points than bytes
                    if edit_every:
                        word = edited(word, salt, edit_every)
                    if len(word) - word.count(b"\xc3") >= min_length:
                        found[word] += n
                if len(found) >= limit:
                    yield rows(found)
                    found = Counter()
        if found:
            yield rows(found)

    return docs.select(F.col("doc_id").alias("doc"), "text").mapInArrow(run, "word string, n long")


def bounds(keys: DataFrame, ranges: int) -> list[str]:
    """Bounds of about equal ranges of ``key``, from a bounded sample that is the same in every run."""
    some = keys.orderBy(F.xxhash64("key"), "key").limit(SAMPLE * ranges).select(F.substring("key", 1, CUT).alias("key"))
    found = sorted(r["key"] for r in some.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def shared_nodes(at: list[str]) -> dict[tuple[int, str], int]:
    """The trie of the bounds: (node, code point) -> node; the root is 0."""
    nodes: dict[tuple[int, str], int] = {}
    for word in at:
        node = 0
        for letter in word:
            node = nodes.setdefault((node, letter), len(nodes) + 1)
    return nodes


def numbered(words: DataFrame, key: str, ranges: int) -> DataFrame:
    """``words`` with ``path``, the numbers of the trie nodes of ``key`` from the root on, and ``place``, a number in
    the order of the keys."""
    columns = words.columns
    keyed = words.withColumn("key", F.expr(key))
    at = bounds(keyed.select("key"), ranges)
    nodes = shared_nodes(at)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [bisect_right(at, k) for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], [*batch.schema.names, "part"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, path, fresh, place = None, "", [0], 0, 0
        for batch in byte_slices(batches, "key", SLICE):
            paths, places = [], []
            for p, word in zip(batch.column("part").to_pylist(), batch.column("key").to_pylist()):
                if p != part:
                    part, before, path, fresh, place = p, "", [0], (p + 1) << 40, p << 40
                path = path[: len(os.path.commonprefix([before, word])) + 1]
                for letter in word[len(path) - 1:]:
                    node = nodes.get((path[-1], letter))
                    if node is None:
                        node, fresh = fresh, fresh + 1
                    path.append(node)
                before = word
                paths.append(path)
                places.append(place)
                place += 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(paths, pa.list_(pa.int64())), pa.array(places, pa.int64())], [*columns, "path", "place"])

    dealt = keyed.mapInArrow(deal, keyed.withColumn("part", F.lit(0).cast("long")).schema).repartition(ranges, "part").sortWithinPartitions("part", "key")
    return dealt.mapInArrow(number, words.withColumns({"path": F.array().cast("array<long>"), "place": F.lit(0).cast("long")}).schema)


def pairs(words: DataFrame) -> DataFrame:
    """(p, s, id, n, kind): the pair dictionary of ``words`` (id, word, n, prefix: its forward path)."""
    both = numbered(words, "reverse(word)", shuffle_partitions(words.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "word", SLICE):
            p, s, kind, of = [], [], [], []
            for row, (word, prefix, suffix) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("word", "prefix", "path")))):
                length = len(word)
                p += prefix
                s += suffix[::-1]
                p += prefix[:-1]
                s += suffix[-2::-1]
                kind += [CUT_HERE] * (length + 1)
                kind += [SKIP if a == b else SKIP_LAST for a, b in zip(word, word[1:])]
                kind.append(SKIP_LAST)
                of += [row] * (2 * length + 1)
            at = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(s, pa.int64()), batch.column("id").take(at), batch.column("n").take(at), pa.array(kind, pa.int8())],
                                             ["p", "s", "id", "n", "kind"])

    return both.select("id", "word", "n", "prefix", "path").mapInArrow(run, "p long, s long, id long, n long, kind byte")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best (lost: -n, id)) of the words that have a near word."""
    met = (pairs(words).groupBy("p", "s").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("lost"), "id", "kind"))).alias("g"))
           .filter("size(g) > 1"))
    parts = met.select("g", F.expr(f"filter(g, m -> m.kind <> {CUT_HERE})").alias("skips"), F.expr(f"get(filter(g, m -> m.kind = {CUT_HERE}), 0)").alias("cut"),
                       F.expr(f"filter(g, m -> m.kind = {SKIP_LAST})").alias("lasts"))
    other = "if(get(skips, 0).id = m.id, get(skips, 1), get(skips, 0))"
    named = lambda x: f"if({x} is null, null, struct({x}.lost as lost, {x}.id as id))"
    best = (f"case when m.kind = {CUT_HERE} then {named('get(lasts, 0)')} when m.kind = {SKIP} then {named(other)} "
            f"else least({named(other)}, {named('cut')}) end")
    near = f"case when m.kind = {CUT_HERE} then size(lasts) when m.kind = {SKIP_LAST} and cut is not null then size(skips) else size(skips) - 1 end"
    found = parts.select(F.inline(F.expr(f"transform(g, m -> struct(m.id as id, {near} as near, {best} as best))"))).filter("near > 0")
    return found.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form): forms are followed to the last, doubling the steps each round."""
    at = written(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5, edit_every: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of at least ``min_length`` code points and ``min_count``
    occurrences.  ``form`` is the near word of largest n, if that is at least ``ratio`` times the word's; ``edit_every``
    plants edits by checksum (the contract's 199)."""
    spark = docs.sparkSession
    words = written(counted(docs, min_length, edit_every).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "spelling-words")
    # a word's place is its id: ids are in the order of the words
    words = written(numbered(words, "word", shuffle_partitions(spark)).withColumnsRenamed({"path": "prefix", "place": "id"}), "spelling-prefixes")
    usual = (-F.col("best.lost")) >= ratio * F.col("n")
    judged = written(words.select("id", "word", "n").join(neighbours(words), "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(usual, F.col("best.id")).alias("form"), F.when(usual, -F.col("best.lost")).alias("form_n")), "spelling-near")
    last = roots(judged.filter("form is not null"))

    def named(column: str) -> DataFrame:
        return words.select(F.col("id").alias(column), F.col("word").alias(f"{column}_word"))

    followed = judged.filter("form is not null").join(last, "id").join(named("form"), "form").join(named("root"), "root")
    whole = followed.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    alone = judged.filter("form is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return whole.unionByName(alone)
