"""The pipeline against a brute-force version of each stage, and planted cases."""

import random
import re

import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from raresight.llm import quality, token_ids
from test_jaccard import brute as brute_jaccard
from test_lines import brute as brute_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_substrings(rows, window):
    """Texts without the covered words, white space after them included."""
    spans = {d: [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for d, t in rows}
    seen, out = {}, {}
    order = sorted(rows)
    for d, t in order:
        w = [t[a:b] for a, b in spans[d]]
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i: i + window]), (d, i))
    for d, t in order:
        w = [t[a:b] for a, b in spans[d]]
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i: i + window])] < (d, i) for j in range(i, i + window)}
        kept, at = "", 0
        for j, (a, _) in enumerate(spans[d]):
            if j in gone:
                kept += t[at:a]
                at = spans[d][j + 1][0] if j + 1 < len(w) else len(t)
        out[d] = kept + t[at:]
    return out


def staged(spark, tmp_path, docs, sf_dir):
    """Rows after each stage, each written and read again."""
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        out.append(docs)
    return out


def has_word(t):
    return re.search(r"[^\x20\x09-\x0D]", t) is not None


def compare(spark, tmp_path, docs, sf_dir):
    stages = staged(spark, tmp_path, docs, sf_dir)
    for s in stages[:4]:
        assert s.columns == docs.columns
        assert all(r.n_chars == len(r.text) for r in s.collect())
    texts = [{r.doc_id: r.text for r in s.collect()} for s in stages[:4]]
    kept = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    source = {r.doc_id: r.text for r in docs.collect()}
    assert texts[0] == {d: source[d] for d in kept}
    assert texts[1] == {d: t for d, t in brute_lines(sorted(texts[0].items())).items() if has_word(t)}
    assert set(texts[2]) == {c for _, _, c in brute_jaccard(sorted(texts[1].items()), 5, 80)}
    assert texts[2].items() <= texts[1].items()
    assert texts[3] == {d: t for d, t in brute_substrings(sorted(texts[2].items()), 20).items() if has_word(t)}
    lib = Tokenizer.from_file(token_ids.vocabulary_path())
    pieces = {}
    for r in stages[4].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    import numpy as np

    assert set(pieces) == set(texts[3])
    for d, t in texts[3].items():
        assert np.frombuffer(b"".join(x for _, x in sorted(pieces[d])), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids + [1]
    return texts


def test_given_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    compare(spark, tmp_path, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert __spark_entry__.queries()["pipeline"](spark, sf).count() > 0


def test_planted_cases(spark, tmp_path):
    rnd = random.Random(1)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(n))
    clean = [text(120) for _ in range(40)]
    passage = text(60)
    rows = list(enumerate(clean))
    rows += [(100, clean[3]), (101, clean[4])]  # copies
    near = clean[5].split()
    near[10] = near[60] = "zzz"
    rows += [(102, " ".join(near))]
    rows += [(103 + i, f"{text(60)} {passage} {text(30)}") for i in range(3)]
    rows += [(200, None), (201, ""), (202, "# $ % " * 60)]
    docs = spark.createDataFrame([(d, t, "en" if d % 2 else None, "s", None if t is None else len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    texts = compare(spark, tmp_path, docs, "")
    assert set(texts[0]) == set(range(40)) | set(range(100, 106))
    assert set(texts[2]) == set(range(40)) | set(range(103, 106))
    assert all(texts[3][d] == clean[d] for d in range(40))
    assert sum(passage in t for t in texts[3].values()) == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a b c")]])
def test_small_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert [s.count() for s in staged(spark, tmp_path, docs, "")] == [0] * 5


def test_extra_columns_pass(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(80)), "en", "s", 5, "x", i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, block long")
    out = staged(spark, tmp_path, docs, "")[3]
    assert out.columns == docs.columns and sorted((r.doc_id, r.kept, r.block) for r in out.collect()) == [(i, "x", i) for i in range(30)]


def test_clashing_names_pass_every_stage(spark, tmp_path):
    """Columns named like the operators' own."""
    rnd = random.Random(3)
    names = ["kept_text", "n_removed", "n_words", "__text", "row", "block", "node", "__row", "__id", "d", "text_"]
    rows = [(i, " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(80)), "en", "s", 5, *[f"{n}{i}" for n in names]) for i in range(30)] + [(40, "x y " * 3, None, None, None, *[None] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    stages = staged(spark, tmp_path, docs, "")
    for out in stages[:4]:
        assert out.columns == docs.columns and sorted((r.doc_id, *r[5:]) for r in out.collect()) == [(i, *[f"{n}{i}" for n in names]) for i in range(30)]
    assert stages[4].select("doc_id").distinct().count() == 30
