"""Source divergence against the definition in whole numbers, and the SQL on the given tables."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

import oracle_check as oc
from raresight.llm import divergence as V
from raresight.llm import queries
from raresight.llm.common import ship

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def f(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, min_documents=10, top=10):
    groups, df = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = Counter(TERM.findall((text or "").translate(LOWER)))
        groups.setdefault((lang, source), Counter()).update(found)
        df.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= min_documents]
        own = {s: c for (la, s), c in groups.items() if la == lang}
        total = sum(own.values(), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(total)
        for s in own:
            pairs = sorted(((sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s), key=lambda x: (-x[0], x[1].encode()))
            terms = sorted(((f(p[s][t], q[t]), t) for t in kept if own[s][t] > 0 and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, value, i + 1) for part, ranked in (("pair", pairs), ("term", terms)) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def found(spark, rows, **options):
    ship(spark)
    docs = spark.createDataFrame([(t, la, s, "x", 1) for t, la, s in rows], "text string, lang string, source string, term string, n long").repartition(5)
    return sorted(tuple(r) for r in V.audit(docs, **options).collect())


def texts(seed, sources, n=150):
    rnd = random.Random(seed)
    words = ["the", "The", "été", "ÉTÉ", "漢字", "x1y", "a_b"] + [f"{a}{b}" for a in "abcdefgh" for b in "pqrstuv"]
    rows = []
    for _ in range(n):
        source = rnd.choice(sources)
        own = words[hash_of(source) % 20:][:25] + words[:7]
        rows.append((" ".join(rnd.choice(own) for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "en", "de", None]), source))
    return rows


def hash_of(source):
    return sum(map(ord, source or ""))


@pytest.mark.parametrize("seed,tile,limit", [(1, 256, 200_000), (2, 2, 5), (3, 3, 50)])
def test_brute_force(spark, monkeypatch, seed, tile, limit):
    """Also with tiny tiles and spills, so that every stripe crosses them."""
    monkeypatch.setattr(V, "TILE", tile)
    monkeypatch.setattr(V, "TILES", 2)
    fold = V.folded
    monkeypatch.setattr(V, "folded", lambda docs: fold(docs, limit))
    rows = texts(seed, ["s0", "s0", "s1", "s2", "é", "", None, "s9"])
    got = found(spark, rows)
    assert got == brute(rows) and any(r[2] == "term" for r in got)


def test_edges(spark):
    rows = [(None, "en", "empty"), ("", "en", "a"), ("123 _ 456", "en", "b"), (None, None, None)]  # no terms: pairs of value 0
    assert found(spark, rows) == brute(rows)
    assert [r[4] for r in found(spark, rows)] == [0] * 6
    rows = [("same words here", "en", s) for s in "abc"] * 5  # ties, repeated rows
    assert found(spark, rows) == brute(rows)
    rows = [("long " * 400_000 + "x", "en", "a"), ("y" * 3_000_000, "en", "a"), *[("long short", "en", "b")] * 12]  # very long texts and words
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_shares_beyond_a_long(spark):
    """10^9 times a count beyond 2^33 passes 64 bits."""
    n, total, v = 5 * 10 ** 12, 9 * 10 ** 15, 10 ** 6
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    assert df.select(V.share(df["n"], "total", "v")).first()[0] == 1 + 10 ** 9 * (n + 2) // (total + 2 * v)


@pytest.mark.parametrize("limit,slices", [(8 << 20, 1), (300, 4), (5, 200)])
def test_folds_whole_batches(monkeypatch, limit, slices):
    """Documents are counted many at once, not one by one; those beyond the limit alone, by pieces."""
    rows = [("Aé b1b, " * 200, "en", "long"), *texts(4, ["s0", "s1", "é"]), ("", "en", "s0"), (None, "en", "s1"), ("été A" * 90, "de", "s0"), ("b1b", "en\0", "long")]
    rows = [(t, la or "", s) for t, la, s in rows]
    batch = pa.RecordBatch.from_pydict({"lang": [r[1] for r in rows], "source": [r[2] for r in rows], "text": pa.array([r[0] for r in rows], pa.string())})
    calls, counted = [], V.counted
    monkeypatch.setattr(V, "counted", lambda text, number: calls.append(len(text)) or counted(text, number))
    got, want = {}, {}
    for out in V.fold(iter([batch.slice(0, 70), batch.slice(70, 0), batch.slice(70)]), limit):
        for r in out.to_pylist():
            assert len({c["source"] for c in r["cells"]}) == len(r["cells"])
            for c in r["cells"]:
                at = got.setdefault((r["lang"], r["term"], c["source"]), [0, 0])
                at[0], at[1] = at[0] + c["docs"], at[1] + c["n"]
    for text, lang, source in rows:
        for term, n in Counter(TERM.findall((text or "").translate(LOWER))).items():
            at = want.setdefault((lang, term, source), [0, 0])
            at[0], at[1] = at[0] + 1, at[1] + n
    assert got == want
    assert len(calls) == 1 if slices == 1 else len(calls) >= slices


@pytest.mark.parametrize("tile,pairs", [(256, 1 << 18), (2, 1 << 18), (3, 7)])
def test_pairs_of_many_terms_at_once(monkeypatch, tile, pairs):
    """Divergences are worked out for the pairs of many terms at once, not term by term."""
    monkeypatch.setattr(V, "TILE", tile)
    monkeypatch.setattr(V, "TILES", 2)
    monkeypatch.setattr(V, "PAIRS", pairs)
    calls, plain = [], V.f
    monkeypatch.setattr(V, "f", lambda p, q: calls.append(1) or plain(p, q))
    rnd = random.Random(7)
    rows = [{"lang": rnd.choice(["en", "de"]), "cells": [{"source": s, "p": rnd.randint(1, 10 ** 9), "p0": 1 + ord(s)} for s in rnd.sample("abcdefgé", rnd.randint(0, 8))]} for _ in range(200)]
    cell = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("p0", pa.int64())]))
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("cells", cell)]))
    got, want = Counter(), Counter()
    for out in V.pair_sums(iter([batch.slice(0, 90), batch.slice(90, 0), batch.slice(90)])):
        for r in out.to_pylist():
            got[r["lang"], r["a"], r["b"]] += r["value"]
    for r in rows:
        for a in r["cells"]:
            for b in r["cells"]:
                if a["source"] != b["source"]:
                    x, x0, y, y0 = a["p"], a["p0"], b["p"], b["p0"]
                    want[r["lang"], a["source"], b["source"]] += f(x, y) - f(x, y0) - f(x0, y) + f(x0, y0)
    assert got == want
    assert pairs == 7 or len(calls) == 8  # four divergences a batch


def test_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    r = oc.compare(spark, oc.duck(sf), "op11", queries.QUERIES["op11_source_divergence"], queries.ORACLE["op11_source_divergence"], sf)
    assert r["status"] == "exact" and "types" not in r, r
