"""Line dedup against its SQL equivalent and against edit distances of all pairs."""

import random
import re

import pytest

import oracle_check as oc
from raresight.llm import lines, queries

SCHEMA = "doc_id long, text string, n_lines string, d string, words string, l string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash", "clash", None) for d, t in rows], SCHEMA).repartition(3)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows, min_words=2):
    found = []
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            w = re.findall(r"[^\x20\x09-\x0D]+", line)
            if w:
                found.append(((d is not None, d or 0, i), w))
    gone = set()
    for at, w in found:
        for other, v in found:
            if other < at and (w == v or (len(w) >= min_words and len(v) >= min_words and one_apart(w, v))):
                gone.add(at)
                break
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d is not None, d or 0, i) not in gone) if t is not None else None for d, t in rows}


def test_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        r = oc.compare(spark, oc.duck(sf), "op4", queries.QUERIES["op4_line_dedup"], queries.ORACLE["op4_line_dedup"], sf)
        assert r["status"] == "exact" and "types" not in r, r


def test_random_edits(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(60)}"
    bases = [[word() for _ in range(n)] for n in (1, 3, 7, 8, 9, 15, 16, 17, 24, 31, 40)] + [["a"] * 12, ["a", "b"] * 8]
    rows = [(None, "\n".join(" ".join(b) for b in bases[:4])), (-1, None), (-2, ""), (-3, "\n \n\t\n")]
    for d in range(150):
        text = []
        for _ in range(rnd.randint(0, 5)):
            w = list(rnd.choice(bases))
            for _ in range(rnd.choice([0, 1, 1, 2])):
                i = rnd.randrange(len(w) + 1)
                w[i: i + rnd.choice([0, 1])] = rnd.choice([[], [word()]])
            text.append(rnd.choice([" ", "  ", "\t"]).join(w) + rnd.choice(["", " ", "\r"]))
        rows.append((d, "\n".join(text)))
    out = lines.dedup_lines(frame(spark, rows), keep=("doc_id", "n_lines")).select("doc_id", "kept_text").collect()
    want = brute(rows)
    assert {r.doc_id: r.kept_text for r in out} == want
    assert sum(len(t or "") for t in want.values()) < 0.9 * sum(len(t or "") for _, t in rows)


def test_long_repeated_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(8000))
    edited = long.replace("w4000 ", "x ")
    shifted = long + " tail"
    rows = [(1, long), (2, edited), (3, shifted), (4, long + "\nnew line"), (4, "another text"), (5, "same same"), (5, "same same")]
    out = lines.dedup_lines(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.kept_text) for r in out) == [(1, long), (2, ""), (3, ""), (4, "another text"), (4, "new line"), (5, "same same"), (5, "same same")]
    assert lines.dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = lines.dedup_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("min_words", [2, 4, 7, 9])
def test_short_lines(spark, min_words):
    """Edits of lines of any length from min_words on, among them pairs of 7 and 8 words."""
    rnd = random.Random(min_words)
    word = lambda: f"w{rnd.randrange(60)}"
    bases = [[word() for _ in range(n)] for n in (*range(1, 11), 16)] + [["a"] * 3, ["a", "b"] * 2]
    rows = []
    for d in range(150):
        w = list(rnd.choice(bases))
        i = rnd.randrange(len(w) + 1)
        w[i: i + rnd.choice([0, 1])] = rnd.choice([[], [word()]])
        rows.append((d, " ".join(w)))
    want = brute(rows, min_words)
    assert {r.doc_id: r.kept_text for r in lines.dedup_lines(frame(spark, rows), min_words=min_words).select("doc_id", "kept_text").collect()} == want
    assert min_words > 8 or want != brute(rows, 9)


def test_floor(spark):
    with pytest.raises(ValueError):
        lines.dedup_lines(frame(spark, []), min_words=1)
