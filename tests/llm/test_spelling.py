"""Spelling variants against the definition, on planted words, long runs and given documents."""

import random
import re
import zlib
from collections import Counter

import pytest

from raresight.llm import spelling
from raresight.llm.common import ship

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_length=6, min_count=5, ratio=5, every=199):
    n = Counter()
    for d, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    by = {}
    for w in n:  # words meet by what is left when one letter goes
        for rest in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by.setdefault(rest, set()).add(w)
    found = {w: set() for w in n}
    for group in by.values():
        for a in group:
            found[a] |= {b for b in group if b not in found[a] and near(a, b)}
    form = {}
    for w, others in found.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(found[w]), n[form[w]] if w in form else None)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def found(spark, docs, **options):
    ship(spark)
    rows = spelling.variants(docs, **options).collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def planted(seed, words=120, alphabet="abé"):
    """Words over few letters, so that most have near ones, with very different counts."""
    rnd = random.Random(seed)
    texts = []
    for _ in range(words):
        w = "".join(rnd.choice(alphabet) for _ in range(rnd.choice([5, 6, 7, 8, 30])))
        texts += [w.upper() if rnd.random() < 0.1 and w.isascii() else w] * rnd.choice([1, 4, 5, 6, 30, 200])
    texts += ["bababx"] * 6 + ["bababxa"] * 40 + ["bababxab"] * 250  # forms that have forms
    rnd.shuffle(texts)
    return [(i, " ".join(texts[i::40])) for i in range(40)]


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    rows = planted(seed)
    expected = brute(rows)
    assert any(v[0] for v in expected.values()) and any(v[1] not in (w, v[0]) for w, v in expected.items())
    assert found(spark, frame(spark, rows), edit_every=199) == expected


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(spark, docs, edit_every=199) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edits_hit_every_place(spark):
    rows = [(i, "abcdefgh hgfedcba") for i in range(3000)]
    got = found(spark, frame(spark, rows), edit_every=3)
    assert got == brute(rows, every=3) and len(got) > 10


def test_runs_of_equal_letters(spark):
    rows = [(i, "aaaaaa aaaaaaa aaaaaaaa aabaaa baaaaaa") for i in range(6)] + [(9, "aaaaaa " * 40)]
    got = found(spark, frame(spark, rows))
    assert got == brute(rows, every=None)
    assert got["aaaaaaa"][3] == 3  # one shorter, one longer, one replaced: each once


def test_nulls_repeats_clashes_and_long_words(spark):
    long = "xy" * 1_000
    rows = [(None, "zebras zebras"), (1, None), (1, ""), (2, f"{long} {long}z"), (2, f"{long} {long}z"), (3, "zebras Zebras ZEBRAS zebrá zebrás"), (4, "×÷×÷×÷ zebrás")] + [(5, f"{long} zebrás ×÷×÷×÷")] * 4
    docs = spark.createDataFrame([(*r, 1, 2, "w", "k") for r in rows], "doc_id long, text string, n long, p long, word string, key string")
    assert found(spark, docs, edit_every=199) == brute(rows)
    assert found(spark, docs.filter("false")) == {}


def test_bounds_and_numbers(spark):
    """Prefixes that cross ranges have one number; different prefixes have different ones."""
    ship(spark)
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(2000)})
    rows = spelling.numbered(spark.createDataFrame([(w,) for w in words], "word string"), "word", 13).collect()
    numbers = {}
    for r in rows:
        for i, node in enumerate(r.path):
            numbers.setdefault(r.word[:i], set()).add(node)
    assert len(rows) == len(words) and all(len(v) == 1 for v in numbers.values())
    assert len({next(iter(v)) for v in numbers.values()}) == len(numbers)


def test_spilled_counts(spark):
    ship(spark)
    rows = [(i, f"common word{'abcdefgh'[i % 8] * 3}") for i in range(200)]
    whole = {r.word: r.n for r in spelling.counted(frame(spark, rows), 6, None, limit=2).groupBy("word").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert whole == Counter(w for _, t in rows for w in t.split())
