"""Substring dedup against the definition."""

import hashlib
import random
import re

import pytest

from raresight.llm import queries, substring

SCHEMA = "doc_id long, text string, n_words string, block string, payload string, estimated string"


def brute_force(rows, window):
    """The definition: doc_id -> (n_words, n_removed, kept_sha256)."""
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    order = sorted(words, key=lambda d: (d is not None, d))
    seen, out = {}, {}
    for rank, d in enumerate(order):
        for i in range(len(words[d]) - window + 1):
            seen.setdefault(tuple(words[d][i: i + window]), (rank, i))
    for rank, d in enumerate(order):
        gone = set()
        for i in range(len(words[d]) - window + 1):
            if seen[tuple(words[d][i: i + window])] < (rank, i):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words[d]) if i not in gone)
        out[d] = (len(words[d]), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(spark, rows, window, run, **options):
    frame = spark.createDataFrame([(d, t, "clash", "clash", "clash", None) for d, t in rows], SCHEMA).repartition(4)
    out = substring.digest(substring.dedup_substrings(frame, window=window, run=run, **options)).collect()
    want = brute_force(rows, window)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == want
    return want


@pytest.mark.parametrize("seed,window,run", [(1, 5, 3), (2, 20, 10), (3, 4, 1), (4, 3, 3)])
def test_random_texts(spark, seed, window, run):
    rnd = random.Random(seed)
    word = lambda v: f"w{rnd.randrange(v)}"
    passage = [word(10 ** 6) for _ in range(60)]
    rows = [(None, " ".join(passage[:window + 3])), (-5, None), (-4, ""), (-3, " \n "), (-2, "a " * 300), (-1, "é漢 " * 40)]
    for d in range(120):
        words = [word(3 if d % 9 == 0 else 10 ** 6) for _ in range(rnd.randint(0, 90))]
        if d % 3 == 0:
            at, n = rnd.randint(0, 40), rnd.randint(1, 20)
            words[5:5] = passage[at: at + n]
        if d % 5 == 0:
            words += passage
        rows.append((d, rnd.choice([" ", "\n", "  ", "\x0b\x0c"]).join(words)))
    rows += [(500 + i, rows[20][1]) for i in range(30)]  # copies
    want = check(spark, rows, window, run, block_bytes=3000)
    assert sum(n for _, n, _ in want.values()) > 500


def test_long_text_and_small_tables(spark):
    rnd = random.Random(5)
    long = " ".join(f"w{rnd.randrange(30000)}" for _ in range(60000))
    check(spark, [(1, long), (2, long[: len(long) // 2])], 20, 10)
    check(spark, [(7, "one two")], 20, 10)
    check(spark, [], 20, 10)


def test_repeated_rows_and_layout(spark):
    words = [f"w{i}" for i in range(40)]
    text = "\n".join(" ".join(words[i: i + 10]) for i in range(0, 40, 10))
    frame = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (2, f"head {text}\ntail", "z"), (3, None, None)], "doc_id long, text string, n_removed string").repartition(3)
    out = sorted(substring.dedup_substrings(frame, keep=("doc_id",), layout=True).collect())
    assert [(r.doc_id, r.n_removed, r.kept_text) for r in out] == [(1, 0, text), (1, 0, text), (2, 40, "head tail"), (3, 0, "")]


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = queries.QUERIES["op1_substring_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute_force(rows, 20)
