"""Jaccard components against all pairs."""

import random
import re

import numpy as np
import pytest

from raresight.llm import jaccard, queries
from raresight.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, node string, component string, block string, n string"


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        d = -10 ** 9 if d is None else d
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((-10 ** 9 if d is None else d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash", "clash", None) for d, t in rows], SCHEMA).repartition(4)


def families(seed, n=260):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    passage = " ".join(word() for _ in range(40))
    bases = [[word() for _ in range(rnd.choice([3, 12, 40, 150]))] for _ in range(8)]
    rows = [(None, "One TWO three"), (-3, None), (-2, ""), (-1, "one two THREE"), (-4, "É é"), (-5, "é é"), (-6, "a " * 50), (-7, "a " * 90)]
    for d in range(n):
        words = list(rnd.choice(bases[:3] if d % 3 else bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4, 8])):
            i = rnd.randrange(len(words))
            words[i: i + rnd.choice([0, 1, 1])] = [rnd.choice([word(), "common"])]
        if d % 7 == 0:
            words = words[: len(words) * 3 // 4] + [passage]
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,size,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60), (4, 1, 90)])
def test_components(spark, seed, size, percent, monkeypatch):
    rows = families(seed)
    got = jaccard.jaccard_join(frame(spark, rows), size, percent, block_bytes=4000).collect()
    key = lambda v: -10 ** 9 if v is None else v
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(rows, size, percent)


def test_hot_groups_are_dealt_out(spark, monkeypatch):
    """Groups larger than a task's share, and components that only other members connect."""
    monkeypatch.setattr(jaccard, "GROUP", 5)
    monkeypatch.setattr(jaccard, "PART", 4)
    for seed in (11, 12):
        rows = families(seed, 150)
        got = jaccard.jaccard_join(frame(spark, rows), 2, 70, block_bytes=3000).collect()
        key = lambda v: -10 ** 9 if v is None else v
        assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(rows, 2, 70)


def test_chains_across_groups(spark, monkeypatch):
    """A chain of documents that drift away from each other: only neighbours link."""
    monkeypatch.setattr(jaccard, "GROUP", 3)
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[2 * i: 2 * i + 60])) for i in range(100)]
    got = jaccard.jaccard_join(frame(spark, rows), 4, 85).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, 85)
    assert {r.component_id for r in got} == {0}


def test_keep_one_and_empty(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, None), (8, None), (7, "other words")]
    out = jaccard.keep_one(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    assert sorted((r.doc_id, r.text, r.node) for r in out.collect()) == [(3, "a b c d e f", "clash"), (7, "other words", "clash"), (8, None, "clash"), (9, None, "clash")]
    assert jaccard.jaccard_join(frame(spark, rows).limit(0)).count() == 0
    assert jaccard.keep_one(frame(spark, rows).limit(0)).count() == 0


def test_link_all_matches_brute_force():
    rnd = random.Random(1)
    for _ in range(30):
        sets = [np.unique(np.array([rnd.randrange(40) for _ in range(rnd.randint(1, 30))], np.uint64)) for _ in range(rnd.randint(1, 25))]
        label = jaccard.link_all(np.array([len(s) for s in sets]), sets, 60)
        rows = [(i, " ".join(f"x{t}" for t in s)) for i, s in enumerate(sets)]
        want = {d: c for d, _, c in brute(rows, 1, 60)}
        assert all((label[i] == label[j]) == (want[i] == want[j]) for i in range(len(sets)) for j in range(i))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 80)] + [(3000, 3000)]
    out = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(201)) and all(out[1000 + i] == 1000 for i in range(80)) and 3000 not in out
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = queries.QUERIES["op5_ngram_jaccard"](spark, sf).collect()
    assert sorted(tuple(r) for r in out) == brute(rows, 4, 85)
