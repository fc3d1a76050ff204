"""Fingerprints and quality rules against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest

from raresight.llm import fingerprints as FP
from raresight.llm import quality as Q
from raresight.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, bucket string, range string, ids string"


def frame(spark, rows, lang="en", source="s"):
    return spark.createDataFrame([(i, t, lang, source, "clash", "clash", "clash", None) for i, t in rows], SCHEMA).repartition(3)


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def prints(spark, texts):
    rows = FP.fingerprints(frame(spark, list(enumerate(texts))), ["text"], ["f"]).collect()
    return {r.doc_id: r.f for r in rows}


def like(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i: i + 4] == b[i: i + 4] for i in range(0, len(a), 4)) / 64


def test_fingerprints_follow_edit_distance(spark):
    rnd = random.Random(4)
    base = words(rnd, 600)
    parts = base.split(" ")
    few = " ".join("x" if i % 60 == 0 else w for i, w in enumerate(parts))
    many = " ".join("x" if i % 6 == 0 else w for i, w in enumerate(parts))
    swapped = " ".join(parts[300:] + parts[:300])  # the same words, the halves exchanged
    other = words(random.Random(5), 600, 10 ** 6)
    f = prints(spark, [base, base, few, many, swapped, other, "", None, "a", "é漢", "x" * 200_000])
    assert f[0] == f[1] and len(f[0]) == 256
    assert like(f[0], f[2]) > 0.6 > like(f[0], f[3]) > like(f[0], f[5])
    assert like(f[0], f[4]) < like(f[0], f[2])  # order counts
    assert f[6] == f[7] == "" and like(f[6], f[7]) == 1 and like(f[0], f[6]) == 0
    assert len({f[8], f[9], f[10]}) == 3


def whole_hash_components(text):
    """The definition on whole k-mer hashes, whatever the text's length."""
    points = np.array([ord(c) for c in text], np.uint64)
    mask = (1 << 64) - 1
    mix = lambda x: int(FP.mix64(np.array([x & mask], np.uint64))[0])
    value = [int(x) for x in FP.mix64(points + np.uint64(1))]
    k = min(FP.K, len(points))
    seen, bins = {}, [[] for _ in range(64)]
    for i in range(len(points) - k + 1):
        h = 0
        for v in value[i: i + k]:
            h = (h * int(FP.ODD) + v) & mask
        kmer = mix(h)
        u = mix(kmer + seen.get(kmer, 0) * int(FP.ODD))
        seen[kmer] = seen.get(kmer, 0) + 1
        bins[u >> 58].append((u, i))
    out = []
    for b in bins:
        two = [u for u, i in sorted(sorted(b)[:2], key=lambda x: x[1])]
        out.append(None if not two else mix(two[0] + int(FP.ODD)) if len(two) == 1 else mix(mix(two[0]) + two[1]))
    if None in out:
        ahead = [next(d for d in range(64) if out[(i + d) % 64] is not None) for i in range(64)]
        out = [mix(out[(i + d) % 64] + d * int(FP.ODD)) for i, d in enumerate(ahead)]
    return "".join(f"{x >> 48:04x}" for x in out)


def test_fingerprints_of_whole_hashes(spark):
    rnd = random.Random(8)
    texts = ["abc", "a" * 30, words(rnd, 3), words(rnd, 40), words(rnd, 700), "été " * 90]
    found = prints(spark, texts)
    for i, t in enumerate(texts):
        assert found[i] == whole_hash_components(t)


@pytest.mark.parametrize("kmers", [64, 1024, 4096])
def test_near_copies_on_both_sides_of_a_power_of_two(spark, kmers):
    """The k-mers' hashes don't depend on the text's length."""
    text = words(random.Random(kmers), kmers)[: kmers + FP.K - 1]
    f = prints(spark, [text[:-1], text, text + "y", text + "yz"])
    assert min(like(f[0], f[1]), like(f[1], f[2]), like(f[1], f[3])) > 0.8


def test_kmers_that_share_high_bits_are_numbered_apart():
    kmers = [9, 8, 9, 8, 8, 1 << 60, 9]  # 8 and 9 differ in bits that the position takes
    kmer, place, occurrence = FP.numbered(np.array(kmers, np.uint64))
    found = {int(p): (int(k), int(o)) for k, p, o in zip(kmer, place, occurrence)}
    assert found == {i: (x, kmers[:i].count(x)) for i, x in enumerate(kmers)}


def test_likeness_column(spark):
    rows = [("", "", 1.0), ("", "0" * 256, 0.0), ("0" * 256, "0" * 252 + "ffff", 63 / 64)]
    out = spark.createDataFrame(rows, "a string, b string, want double").select(FP.likeness("a", "b").alias("got"), "want").collect()
    assert all(r.got == r.want for r in out)


@pytest.mark.parametrize("ids", [[5, 1, 9, 3], [7], [2, 2, 1], [None, 4, 1], [], list(range(500))])
def test_with_next(spark, ids):
    rows = [(i, f"t{i}-{k}" if k % 7 else None) for k, i in enumerate(ids)]
    out = FP.with_next(frame(spark, rows)).collect()
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    want = sorted((t, order[(k + 1) % len(order)][2]) for k, (_, _, t) in enumerate(order))
    assert sorted((r.text, r.next_text) for r in out) == want


def test_op9_query(spark):
    out = {r.doc_id: r for r in queries.QUERIES["op9_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    order = sorted(docs)
    assert sorted(out) == order
    for i, d in enumerate(order):
        text, after = docs[d], docs[order[(i + 1) % len(order)]]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        assert out[d].n_chars == len(text) and out[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    near = sum(r.near_edited for r in out.values()) / len(out)
    assert near > 0.3 and near > 5 * sum(r.near_next for r in out.values()) / len(out)


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
    hit = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), dup, len(hit))


def test_counts(spark):
    rnd = random.Random(2)
    texts = ["", None, " \n\t ", "a b c a b c", "x\nx\n \n y\ny", "é#é <b>|", "a a a a a", "one two\x0bthree\x0cfour", "\x1c \x85"]
    texts += ["".join(rnd.choice("ab é\n#\t ") for _ in range(rnd.randint(0, 200))) for _ in range(60)] + [words(rnd, 3000, 40)]
    out = Q.counts(frame(spark, list(enumerate(texts))), ["doc_id", "bucket"]).collect()
    assert len(out) == len(texts)
    for r in out:
        assert tuple(r[c] for c in Q.COUNTS) == brute_counts(texts[r.doc_id]), texts[r.doc_id]


def test_judge_fences_and_fallback(spark):
    rnd = random.Random(6)
    good = [(i, words(rnd, 120, 10 ** 6), "en", "big" if i % 2 else "big2") for i in range(400)]
    few = [(1000 + i, words(rnd, 120, 10 ** 6), None, None) for i in range(3)]
    junk = [(2000 + i, " ".join(w + "###" for w in words(rnd, 120, 10 ** 6).split()), "en", "big") for i in range(5)]
    short = [(3000, "too short", "en", "big"), (3001, "same words here " * 40, "en", "big"), (3002, None, "en", "big"), (3003, "", None, "x")]
    rows = spark.createDataFrame([(i, t, la, s, "c") for i, t, la, s in good + few + junk + short], "doc_id long, text string, lang string, source string, metric string")
    out = {r.doc_id: r for r in Q.judge(rows).collect()}
    assert len(out) == 412
    assert all(out[r[0]].kept for r in good + few)
    assert not any(out[r[0]].kept or out[r[0]].base_failed for r in junk)
    assert all(out[r[0]].base_failed and not out[r[0]].kept for r in short)
    kept = Q.keep_good(rows)
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in good + few}
    assert Q.judge(rows.limit(0)).count() == 0


def test_thresholds_merge_in_any_order(spark):
    """The sketch is a table of counts: the fences don't depend on how rows are partitioned."""
    rnd = random.Random(7)
    rows = frame(spark, [(i, words(rnd, 60 + i % 50, 5000)) for i in range(300)])
    counted = Q.counts(rows, ["lang", "source"])
    a = Q.thresholds(counted.repartition(7), ["lang", "source"]).collect()
    b = Q.thresholds(counted.coalesce(1), ["lang", "source"]).collect()
    assert a == b
    exact = sorted(r.word_chars / r.n_words for r in counted.collect())
    q1, q3 = exact[74], exact[224]
    assert abs(a[0].word_length_high - (q3 + 3 * (q3 - q1) + 1.0)) < 0.1 * q3


def brute_kept(rows, weight=Q.WEIGHT):
    """Verdicts by the definition: quantiles of log buckets, mixed from the table down to (language, source)."""
    import math

    metric = {"word_length": lambda c: (c[1], c[0]), "symbols": lambda c: (c[2], c[0]), "dup_lines": lambda c: (c[4], c[3]), "repeats": lambda c: (c[5], c[0])}
    counted = {r[0]: brute_counts(r[1]) for r in rows}
    base = {d: c[0] < 50 or 100 * c[5] > 50 * c[0] for d, c in counted.items()}

    def own(members, m):
        values = [a / b for a, b in (metric[m](counted[d]) for d in members)]
        buckets = sorted(-math.inf if v == 0 else math.ceil(math.log(v) / math.log(Q.GAMMA)) for v in values)
        at = lambda q: buckets[max(0, math.ceil(q * len(buckets)) - 1)]
        middle = lambda b: 0.0 if b == -math.inf else Q.GAMMA ** (b - 0.5)
        above = [b for b in buckets if b != -math.inf]
        common = Q.GAMMA ** above[max(0, math.ceil(Q.COMMON * len(above)) - 1)] if above else None
        return {"q1": middle(at(0.25)), "q3": middle(at(0.75)), "common": common}

    passing = [r for r in rows if not base[r[0]]]
    out = {}
    for d, _, lang, source in rows:
        if base[d]:
            out[d] = False
            continue
        levels = [[r[0] for r in passing], [r[0] for r in passing if r[2] == lang], [r[0] for r in passing if r[2:] == (lang, source)]]
        ok = True
        for m, (_, sides, tolerance) in Q.METRICS.items():
            mixed = {"q1": 0.0, "q3": 0.0, "common": 0.0}
            for i, members in enumerate(levels):
                mine = own(members, m)
                for c in mixed:
                    value = mixed[c] if mine[c] is None else mine[c]
                    mixed[c] = value if i == 0 else (len(members) * value + weight * mixed[c]) / (len(members) + weight)
            a, b = metric[m](counted[d])
            spread = Q.FENCE * (mixed["q3"] - mixed["q1"])
            high = max(mixed["q3"] + spread, mixed["common"]) if tolerance is None else mixed["q3"] + spread + tolerance
            ok &= a / b <= high and ("low" not in sides or a / b >= mixed["q1"] - spread - tolerance)
        out[d] = ok
    return out


def varied(seed, n=500):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        lang, source = rnd.choice(["en", "de", None]), rnd.choice(["a", "a", "a", "b", "c", None])
        long = 6 if (lang, source) == ("de", "b") else 2
        text = [rnd.choice("abcdefg") * rnd.randint(long, long + 5) + str(rnd.randrange(10 ** 5)) for _ in range(rnd.randint(40, 90))]
        if rnd.random() < 0.1:
            text += ["###", "$%"] * rnd.randint(1, 30)
        lines = [" ".join(text[j: j + 9]) for j in range(0, len(text), 9)]
        if rnd.random() < 0.3:
            lines += lines[: rnd.randint(1, 5)]
        rows.append((i, "\n".join(lines), lang, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_kept_brute_force(spark, seed):
    rows = varied(seed)
    out = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert out == brute_kept(rows)
    assert 0.5 < sum(out.values()) / len(out) < 1


def test_no_verdict_hangs_on_the_number_of_documents(spark):
    """A source of long words beside others: a few documents more change few verdicts, at every size."""
    rnd = random.Random(9)
    text = lambda size: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(size, size + 4))) for _ in range(100))
    rows = [(i, text(4), "en", "other") for i in range(400)] + [(1000 + i, text(9), "en", "src") for i in range(130)]
    kept = []
    for n in (60, 62, 96, 98, 100, 102, 130):
        some = spark.createDataFrame([r for r in rows if r[0] < 1000 + n], "doc_id long, text string, lang string, source string")
        kept.append(sum(r.kept for r in Q.judge(some).collect() if r.doc_id >= 1000))
    assert all(abs((b - a)) <= 2 + 2 for a, b in zip(kept[:2], kept[1:2])) and all(abs(b - a) <= 4 for a, b in zip(kept[2:6], kept[3:6])) and kept[-1] >= 125, kept


def test_next_document_with_null_and_large_ids(spark):
    """Ids beyond 2^53 beside a null id: every row comes out, each with the next one's text."""
    ids = [2 ** 60 + i for i in range(300)] + [None, -(2 ** 62), 2 ** 63 - 1]
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(7)
    out = FP.with_next(rows, partitions=5).collect()
    order = sorted(ids, key=lambda i: (i is not None, i))
    assert {r.doc_id: (r.text, r.next_text) for r in out} == {a: (f"t{a}", f"t{b}") for a, b in zip(order, order[1:] + order[:1])}
    assert len(out) == len(ids)
