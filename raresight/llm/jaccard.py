"""N-gram Jaccard join: documents whose shingle sets are alike, as components.

A document's set is its distinct word n-grams (as 64-bit hashes of the words).  Two documents link
when ``100 * intersection >= percent * union``.

1. Equal sets are one class: blocks send the hashes of their sets and learn which block holds a class
   first.  Then they send a count-min sketch of the shingles of the classes they hold first; the answers
   tell which shingles can occur in two classes, and how common each is.
2. The bound of a set against all others together: a document links with something only if
   ``percent`` of its shingles occur elsewhere.  Most documents end here.  The rest keep just the
   shingles that can be shared, ordered by hash.
3. The token-group matrix.  Documents are grouped by their first shingle (documents alike mostly have the same
   one); a group that is too large for a task is dealt out by hash.  Each group is one task's: it links
   its documents exactly, comparing a document only with those not yet in its component.
4. Each component of a group stores the union of its members' prefixes (the rarest shingles, so many that
   two linked documents must share one: a common passage is in no prefix of a document with enough other shingles).  Each component first tries the largest component that shares a
   prefix shingle with it, by their first documents.  Then only components of still different clusters
   that share a prefix shingle are left; they are grouped anew by the prefix shingle that most of them
   hold, and a component asks the groups that hold one of its prefix shingles.  A group is opened for
   a document only if the document's overlap with the union of the members' shingles reaches the bound.
   A group that many documents ask is copied, and the documents that ask are dealt to the copies by hash.
5. The links between components give the final components; classes and documents follow.

Everything is exact up to equal 64-bit hashes of different shingles.  Null text, and text without
words, has an empty set, links with nothing and is its own component.  Rows that share a doc_id are
judged by their own texts; a null doc_id counts as the least.  An empty table gives an empty table;
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.llm import blocks as B
from raresight.llm.common import id_numbers, mix64, shuffle_partitions, utf8, word_hashes, word_spans, written
from raresight.llm.components import components
from raresight.llm.substring import MULTIPLIERS, WORD_BYTES, run_hashes

GROUP = 4096  # documents that one task links; a larger group is dealt out by hash
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32
PART = 2048  # documents of a part of a group of the second half of step 4
SMALL_TABLE = 50_000  # rows of a broadcast side, counted first


def least_overlap(n, percent: int):
    """A linked document of ``n`` shingles shares at least so many."""
    return -(-percent * n // 100)


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every row of a block."""
    data, offsets = utf8(batch.column("__text"))
    data = TO_LOWER[data]
    first, end, row = word_spans(data, offsets)
    words = word_hashes(data, first, end)
    cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
    grams = run_hashes(words, size, MULTIPLIERS[0]) if len(words) >= size else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(cut, cut[1:]):
        if b - a >= size:
            out.append(np.unique(grams[a: b - size + 1]))
        elif b > a:  # fewer words: the whole sequence is one shingle, of its own length
            out.append(run_hashes(words[a:b], b - a, MULTIPLIERS[0]) + np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Sets:
    """Sets of a block: which rows are a block's first of their class, and the classes' 128-bit names."""

    def __init__(self, block: int, batch: pa.RecordBatch, size: int, range_bits: int):
        self.sets = shingle_sets(batch, size)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.filled = np.flatnonzero(self.sizes)
        names = [np.array([int(mix64(s ^ m).sum() + np.uint64(len(s))) & ((1 << 64) - 1) for s in self.sets], np.uint64) for m in MULTIPLIERS]
        self.names = names
        high, low = (n[self.filled] for n in names)
        self.keys = B.Keys(high, low, np.full(len(self.filled), block, np.int64), self.filled, range_bits)
        self.own = self.filled[self.keys.position[self.keys.inverse] == self.filled]  # first of their class in this block

    def hold(self, answer: list[dict]) -> None:
        """Keep the classes that no other block holds first."""
        later = np.zeros(len(self.sets), bool)
        later[self.filled] = self.keys.elsewhere_earlier(answer)
        self.own = self.own[~later[self.own]]

    def name(self, row: int) -> bytes:
        return int(self.names[0][row]).to_bytes(8, "big") + int(self.names[1][row]).to_bytes(8, "big")

    def tokens(self) -> np.ndarray:
        return np.concatenate([self.sets[r] for r in self.own]) if len(self.own) else np.zeros(0, np.uint64)


def link_all(sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component number of every set: breadth first, each set compared with those not yet reached."""
    n = len(sets)
    label = np.full(n, -1, np.int64)
    if not n:
        return label
    length = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(length) - length
    mark = np.zeros(int(codes.max(initial=0)) + 1, bool)
    rest, rest_codes = np.arange(n), codes  # sets not yet in a component, and their tokens

    def shrink():
        nonlocal rest, rest_codes
        keep = label[rest] < 0
        rest_codes = rest_codes[np.repeat(keep, length[rest])]
        rest = rest[keep]

    number = 0
    while len(rest):
        queue = [int(rest[0])]
        label[queue[0]] = number
        shrink()
        while queue and len(rest):
            x = queue.pop()
            own = codes[start[x]: start[x] + length[x]]
            mark[own] = True
            hits = np.concatenate([[0], np.cumsum(mark[rest_codes])])
            ends = np.cumsum(length[rest])
            shared = hits[ends] - hits[ends - length[rest]]
            mark[own] = False
            near = rest[100 * shared >= percent * (sizes[x] + sizes[rest] - shared)]
            if len(near):
                label[near] = number
                queue += near.tolist()
                shrink()
        number += 1
    return label


def by_key(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows in runs of equal ``columns`` (the input is sorted by them)."""
    key, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            k = tuple(r[c] for c in columns)
            if rows and k != key:
                yield key, rows
                rows = []
            key = k
            rows.append(r)
    if rows:
        yield key, rows


def array_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u8")


def family_components(sets: DataFrame, percent: int) -> DataFrame:
    """Step 3.  Rows with a node: its component.  Rows without: a component (its first document, sizes, prefix union)."""
    spark = sets.sparkSession
    hot = written(sets.groupBy("least").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("least", F.ceil(F.col("n") / GROUP).alias("parts")), "hot-groups")
    dealt = sets.join(F.broadcast(hot) if hot.count() <= SMALL_TABLE else hot, "least", "left")
    dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("node"), F.col("parts")), F.lit(0))).drop("parts")
    schema = "node binary, component binary, least long, part long, n_docs long, least_n long, most_n long, prefix array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (least, part), rows in by_key(batches, ("least", "part")):
            tokens = [array_of(r["tokens"]) for r in rows]
            sizes = np.array([r["n"] for r in rows], np.int64)
            label = link_all(sizes, tokens, percent)
            head = {}
            for i, k in enumerate(label.tolist()):
                head.setdefault(k, i)
            out = [(r["node"], rows[head[k]]["node"], None, None, None, None, None, None) for r, k in zip(rows, label.tolist())]
            order = np.argsort(label, kind="stable")
            for members in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
                prefix = np.unique(np.concatenate([tokens[i][: len(tokens[i]) - least_overlap(int(sizes[i]), percent) + 1] for i in members]))
                first = rows[head[int(label[members[0]])]]["node"]
                out.append((None, first, least, part, len(members), int(sizes[members].min()), int(sizes[members].max()), prefix.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.list_(pa.int64())])],
                                             ["node", "component", "least", "part", "n_docs", "least_n", "most_n", "prefix"])

    n = shuffle_partitions(spark)
    return written(dealt.repartition(n, "least", "part").sortWithinPartitions("least", "part", "node").mapInArrow(run, schema), "group-components")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) of nodes with ``link``: whether the two documents link."""
    tokens = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    both = pairs.join(tokens, "a").join(tokens.toDF("b", "n_b", "tokens_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                rows = whole.slice(at, 256).to_pylist()
                found = []
                for r in rows:
                    shared = len(np.intersect1d(array_of(r["tokens_a"]), array_of(r["tokens_b"]), assume_unique=True))
                    found.append(100 * shared >= percent * (r["n_a"] + r["n_b"] - shared))
                yield pa.RecordBatch.from_arrays([pa.array([r["a"] for r in rows], pa.binary()), pa.array([r["b"] for r in rows], pa.binary()), pa.array(found)], ["a", "b", "link"])

    return both.select("a", "n_a", "tokens_a", "b", "n_b", "tokens_b").mapInArrow(run, "a binary, b binary, link boolean")


def opened(queries: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Step 4, second half: links (a, b) between components of different clusters.

    ``members``: group, part, node, component, cluster, n, tokens of every document of the groups; ``queries``: group,
    part and the component (of n_docs documents) whose documents are compared with that group.  A part has a copy for
    every PART documents that ask it."""
    columns = ["group", "part", "copy", "query", "component", "cluster", "n", "tokens"]
    copies = queries.groupBy("group", "part").agg(F.ceil(F.sum("n_docs") / PART).alias("copies"))
    documents = members.select("node", "component", "cluster", "n", "tokens")
    asked = (queries.join(copies, ["group", "part"]).join(documents, "component")
             .withColumn("copy", F.pmod(F.xxhash64("node"), F.col("copies"))).withColumn("query", F.lit(1)))
    groups = members.join(copies, ["group", "part"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn("query", F.lit(0))
    rows = (groups.select(columns).union(asked.select(columns))
            .repartition(shuffle_partitions(members.sparkSession), "group", "part", "copy").sortWithinPartitions("group", "part", "copy", "query", "component"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, inside, done = None, [], set()
        union = None
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                if (r["group"], r["part"], r["copy"]) != group:
                    group, inside, done, union = (r["group"], r["part"], r["copy"]), [], set(), None
                if not r["query"]:
                    inside.append((r["component"], r["cluster"], r["n"], array_of(r["tokens"])))
                    continue
                if union is None:
                    union, codes = np.unique(np.concatenate([x[3] for x in inside]), return_inverse=True)
                    row = np.repeat(np.arange(len(inside)), [len(x[3]) for x in inside])
                    sizes = np.array([x[2] for x in inside])
                    by_token = np.argsort(codes, kind="stable")
                    first = np.searchsorted(codes[by_token], np.arange(len(union) + 1))
                own = array_of(r["tokens"])
                at = np.minimum(np.searchsorted(union, own), len(union) - 1)
                common = at[union[at] == own]
                if len(common) < least_overlap(r["n"], percent):
                    continue  # no member can reach the bound
                holders = np.concatenate([row[by_token[first[c]: first[c + 1]]] for c in common.tolist()])
                shared = np.bincount(holders, minlength=len(sizes))
                for i in np.flatnonzero(100 * shared >= percent * (r["n"] + sizes - shared)).tolist():
                    pair = (r["cluster"], inside[i][1])
                    if pair[0] != pair[1] and pair not in done:
                        done.add(pair)
                        found.append((r["component"], inside[i][0]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def classes(blocks: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows: block, row, id, n, node), (node, component) of the classes that may link."""
    words = B.total_bytes(blocks) / WORD_BYTES
    sketch = B.LevelSketch(int(words), load=0.5)
    range_bits = B.range_bits_for(words / 256)

    def ask_first(block, batch, _):
        found = Sets(block, batch, size, range_bits).keys.packed()
        if found:
            yield B.questions(block, found)

    first = written(B.gathered(B.find_first(B.each_block(blocks, ask_first, B.QUESTION)), "first"), "class-first")

    def ask_counts(block, batch, given):
        s = Sets(block, batch, size, range_bits)
        s.hold(given["first"])
        found = sketch.partial(s.tokens())
        if found:
            yield B.questions(block, found)

    held = B.with_answers(blocks, first=first)
    counted = written(B.gathered(B.merge_levels(B.each_block(held, ask_counts, B.QUESTION, ("first",))), "counted"), "shingle-counts")

    def survivors(block, batch, given):
        s = Sets(block, batch, size, range_bits)
        s.hold(given["first"])
        level = sketch.levels(s.tokens(), given["counted"])
        at = np.concatenate([[0], np.cumsum(s.sizes[s.own])]).tolist()
        node, n, least, tokens = [], [], [], []
        for r, a, b in zip(s.own.tolist(), at, at[1:]):
            shared = level[a:b] > 0
            kept = s.sets[r][shared]
            if len(kept) and 100 * len(kept) >= percent * int(s.sizes[r]):
                node.append(s.name(r))
                n.append(int(s.sizes[r]))
                least.append(int(kept[:1].view(np.int64)[0]))
                tokens.append(kept[np.argsort(level[a:b][shared], kind="stable")].astype("<u8").tobytes())
        numbers = id_numbers(batch.column("__id"))
        m = batch.num_rows
        names = [s.name(r) if s.sizes[r] else None for r in range(m)]
        none = [None] * len(node)
        # two kinds of rows in one pass over the texts: documents, then sets that may link
        yield pa.RecordBatch.from_arrays([
            pa.array([block] * m + none, pa.int64()), pa.array([*range(m), *none], pa.int64()), pa.array([*numbers.tolist(), *none], pa.int64()), pa.array([*s.sizes.tolist(), *n], pa.int64()),
            pa.array([*names, *node], pa.binary()), pa.array([None] * m + least, pa.int64()), pa.array([None] * m + tokens, pa.binary())],
            ["block", "row", "id", "n", "node", "least", "tokens"])

    both = written(B.each_block(B.with_answers(blocks, first=first, counted=counted), survivors, "block long, row long, id long, n long, node binary, least long, tokens binary", ("first", "counted")), "shingle-sets")
    rows = both.filter("tokens is null").select("block", "row", "id", "n", "node")
    sets = both.filter("tokens is not null").select("node", "n", "least", "tokens")

    grouped = family_components(sets, percent)
    members = grouped.filter("node is not null").select("node", "component")
    heads = grouped.filter("node is null").drop("node")
    index = written(heads.select("component", "least", "part", "least_n", "most_n", "n_docs", F.explode("prefix").alias("token")), "group-index")

    # first a star: each component tries the largest component that it shares a prefix shingle with, one pair each
    centre = index.groupBy("token").agg(F.max(F.struct("n_docs", "component")).alias("c"), F.count("*").alias("holders")).filter("holders > 1").select("token", "c")
    star = (index.join(centre, "token").groupBy("component").agg(F.max("c").alias("c")).filter("component <> c.component")
            .select(F.col("component").alias("a"), F.col("c.component").alias("b")))
    tried = written(linked(star, sets, percent), "star-links")
    # then only pairs that are still apart: of tokens that components of different clusters hold
    cluster = components(tried.filter("link").select("a", "b")).select(F.col("node").alias("component"), F.col("label").alias("cluster"))
    clustered = index.join(cluster, "component", "left").withColumn("cluster", F.coalesce("cluster", "component"))
    shared = clustered.groupBy("token").agg((F.min("cluster") != F.max("cluster")).alias("apart")).filter("apart").select("token")
    apart = written(clustered.join(shared, "token", "left_semi"), "group-index-apart")
    # they are grouped anew, by the prefix shingle that most of them hold, in parts of about PART documents
    held_by = apart.join(apart.groupBy("token").agg(F.count("*").alias("holders")), "token")
    grouped_by = held_by.groupBy("component", "cluster", "n_docs", "least_n", "most_n").agg(F.max(F.struct("holders", "token"))["token"].alias("group"))
    parts = grouped_by.groupBy("group").agg(F.ceil(F.sum("n_docs") / PART).alias("parts"))
    placed = written(grouped_by.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("component"), F.col("parts"))).drop("parts"), "group-parts")
    part_sizes = placed.groupBy("group", "part").agg(F.min("least_n").alias("least_part"), F.max("most_n").alias("most_part"))
    fits = (100 * F.col("most_n") >= percent * F.col("least_part")) & (100 * F.col("most_part") >= percent * F.col("least_n"))
    # a component asks its own and later parts of its group, and the parts of later groups that hold one of its
    # prefix shingles: of two components one asks
    own = placed.withColumnRenamed("part", "own_part").join(part_sizes, "group").filter(fits & (F.col("own_part") <= F.col("part"))).select("component", "n_docs", "group", "part")
    holding = apart.select("token", "component").join(placed.select("component", "group", "part"), "component").select("token", F.col("group").alias("other"), "part").distinct()
    asking = apart.select("token", "component").join(placed.select("component", "n_docs", "group", "least_n", "most_n"), "component")
    later = (asking.join(holding, "token").filter("group < other").select("component", "n_docs", F.col("other").alias("group"), "part", "least_n", "most_n").distinct()
             .join(part_sizes, ["group", "part"]).filter(fits).select("component", "n_docs", "group", "part"))
    queries = written(own.union(later), "group-queries")
    documents = members.join(placed.select("component", "cluster", "group", "part"), "component").join(sets, "node").select("group", "part", "node", "component", "cluster", "n", "tokens")
    links = tried.filter("link").select("a", "b").union(opened(queries, documents, percent))
    labels = components(links)
    joined = members.join(labels, members["component"] == labels["node"], "left").select(members["node"], F.coalesce("label", "component").alias("component"))
    return rows, written(joined, "class-components")


def components_of(docs: DataFrame, size: int, percent: int, text: str, keep: Sequence[str], block_bytes: int) -> tuple[DataFrame, DataFrame]:
    blocks = B.block_table(docs.select(*keep, F.col("doc_id").cast("long").alias("__id"), F.col(text).alias("__text")), "__text", block_bytes)
    rows, of_class = classes(blocks, size, percent)
    named = rows.join(of_class, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return blocks, written(named.select("block", "row", "id", "n", "component"), "document-components")


def jaccard_join(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", block_bytes: int = B.SLICE_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) per row of ``docs``."""
    _, named = components_of(docs, size, percent, text, (), block_bytes)
    least = named.filter("component is not null").groupBy("component").agg(F.min("id").alias("least_id"))
    null_id = F.lit(-(1 << 63))
    return named.join(least, "component", "left").select(
        F.nullif("id", null_id).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(F.coalesce("least_id", "id"), null_id).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", block_bytes: int = B.SLICE_BYTES) -> DataFrame:
    """One row of each component (the least doc_id's, the first of equal ones) with all its columns."""
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.col(text).alias("text"))  # one column, so that no name clashes
    blocks, named = components_of(whole, size, percent, "text", ("row",), block_bytes)
    first = named.filter("component is not null").groupBy("component").agg(F.min(F.struct("id", "block", "row")).alias("x")).select("x.block", "x.row")
    kept = first.union(named.filter("component is null").select("block", "row"))
    chosen = kept.groupBy("block").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def take(block, batch, given):
        yield batch.select(["row"]).take(pa.array(given["rows"], pa.int64()))

    return B.each_block(blocks.join(chosen, "block"), take, whole.select("row").schema, ("rows",)).select("row.*")
