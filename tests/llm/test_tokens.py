"""Encoding, token files and packing against the public libraries and brute force."""

import base64
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from raresight.llm import bpe, packing, token_files, token_ids
from raresight.llm.pretokens import Pieces

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
EDGE = ["", None, "a", " ", "  ", "\n \n", "it's we're I'VE 'tis '' 's 're're", "x" * 5000, " " * 3000, "été 漢字 123½ ٣ 😀!!\r\n\ttab", "a b   c", "<|endoftext|> x", "\x00\x1c\x85"]
SCHEMA = "doc_id long, text string, n_tokens string, ids string, part string, rest string"


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(3)
    letters = "ab'strevldm  \n\t 　é9²-!漢😀''  "
    return EDGE + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(150)] + ["the same text"] * 3


def table(spark, values=None, ids=None):
    values = texts() if values is None else values
    rows = [(i if ids is None else ids[i], t, "clash", "clash", None, "x") for i, t in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_pieces_match_the_pattern():
    values = [t or "" for t in texts()]
    p = Pieces(pa.array(values))
    cuts = np.append(p.starts, len(p.data))
    found = [bytes(p.data[a:b]).decode() for a, b in zip(cuts, cuts[1:])]
    at = 0
    for t, n in zip(values, p.counts):
        assert found[at: at + n] == regex.findall(P.PATTERN, t)
        at += n


def test_every_code_point_is_cut_as_the_library_cuts_it():
    lib = library()
    known = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    values = [f"a{c}1{c} {c}!" for c in known[:: 7]] + [f"a{c}1{c} {c}!" for c in known[:1500]]
    v = bpe.vocabulary(RANKS)
    ids, counts, _ = v.pieces.ids(Pieces(pa.array(values)))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    wrong = [t for t, a, b in zip(values, cuts, cuts[1:]) if ids[a:b].tolist() != lib.encode_ordinary(t)]
    assert wrong == []


def test_long_pieces_merge_like_the_library():
    rnd, lib, ranks = random.Random(9), library(), bpe.load_ranks(RANKS)
    for n in (65, 300, 4000):
        piece = "".join(rnd.choice("abcdeinthr") for _ in range(n)).encode()
        assert bpe.merge_long(piece, ranks) == lib._encode_single_piece(piece)


def test_encode_and_decode(spark):
    lib = library()
    out = bpe.decode(bpe.encode(table(spark), RANKS, keep=("doc_id", "part")), RANKS, keep=("doc_id", "part", "ids", "offsets")).collect()
    assert len(out) == len(texts())
    for r in out:
        text = texts()[r.doc_id] or ""
        assert r.ids == lib.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
        assert r.offsets == sorted(r.offsets) and len(r.offsets) == len(r.ids)


def test_encode_empty_table_and_null_lists(spark):
    assert bpe.encode(table(spark).limit(0), RANKS).count() == 0
    frame = spark.createDataFrame([(1, None, None), (2, [], [])], "doc_id long, ids array<int>, offsets array<int>")
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in bpe.decode(frame, RANKS).collect()} == {1: None, 2: b""}


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_token_files(spark, id_bytes):
    values = texts()
    lib = Tokenizer.from_file(JSON)
    lib.encode_special_tokens = True
    manifest = token_files.write_token_files(table(spark, values), JSON, 2, id_bytes=id_bytes, partitions=4)
    got = {r.doc_id: r for r in token_files.read_token_files(manifest).collect()}
    start = 0
    for i, t in enumerate(values):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[i].ids == ids and got[i].start == start and got[i].n_tokens == len(ids)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(values)


def test_token_files_null_ids_ties_and_empty(spark):
    manifest = token_files.write_token_files(table(spark, ["b", "a", "c"], [None, 5, 5]), JSON, 2)
    got = sorted((r.start, r.doc_id) for r in token_files.read_token_files(manifest).collect())
    assert [d for _, d in got] == [None, 5, 5]
    empty = token_files.write_token_files(table(spark).limit(0), JSON, 2)
    assert token_files.read_token_files(empty).count() == 0


def test_pack_histogram_places_everything():
    rnd = random.Random(1)
    for capacity, n in ((16, 300), (64, 2000), (2048, 5000), (8, 3)):
        histogram = {}
        for _ in range(n):
            length = rnd.randint(1, capacity - 1)
            histogram[length] = histogram.get(length, 0) + rnd.choice([1, 1, 1, 40])
        patterns = packing.pack_histogram(dict(histogram), capacity)
        placed = {}
        for pattern, packs in patterns:
            assert sum(a * b for a, b in pattern) <= capacity
            for length, times in pattern:
                placed[length] = placed.get(length, 0) + times * packs
        assert placed == histogram
        if n > 1000:
            used = sum(a * b for a, b in histogram.items())
            assert used / (capacity * sum(p for _, p in patterns)) > 0.95


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(spark, capacity):
    values = texts()
    lib = Tokenizer.from_file(JSON)
    lib.encode_special_tokens = True
    out = packing.pack(table(spark, values), JSON, 1, capacity).collect()
    whole, sequences = {}, {}
    for r in out:
        whole.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in enumerate(values):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        found, at = [], 0
        for r in sorted(whole[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.frombuffer(bytes(r.ids), "<u4").tolist()
            assert len(part) == r.length > 0
            found += part
            at += r.length
        assert found == ids
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))


def test_pack_repeated_null_and_empty(spark):
    out = packing.pack(table(spark, ["a b", "a b", None], [7, 7, None]), JSON, 1, 16).collect()
    assert sorted((r.doc_id or 0, r.length) for r in out) == [(0, 1), (7, 3), (7, 3)]
    assert packing.pack(table(spark).limit(0), JSON, 1).count() == 0


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "a  <|endoftext|>\n", "<|endoftext|", "é<|endoftext|>é <|endoftext|>", "<|endoftext|>s", "plain"]


@pytest.mark.parametrize("some", [ADDED, EDGE, texts() + ADDED, ["plain"], [None, "<|endoftext|>", None], []])
def test_added_tokens_as_the_library_as_it_is(some):
    lib = Tokenizer.from_file(JSON)
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in some]
    ids, counts = token_ids.encode_column(pa.array(some, pa.string()), JSON, added=True)
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    ids, counts = token_ids.encode_column(pa.array(some, pa.string()), JSON, 7, added=True)
    assert counts.tolist() == [len(w) + 1 for w in want] and ids.tolist() == [i for w in want for i in [*w, 7]]


def test_queries_encode_added_tokens(spark, tmp_path):
    """op7, op8 and the pipeline's last stage: ids, places and crc32 of texts with an added token's string."""
    import corpus_pipeline
    from raresight.llm import queries

    values, lib = texts() + ADDED, Tokenizer.from_file(JSON)
    table(spark, values).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in values]
    start = 0
    for r in queries.QUERIES["op8_token_files"](spark, str(tmp_path)).orderBy("doc_id").collect():
        ids = want[r.doc_id] + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for r in queries.QUERIES["op7_packing"](spark, str(tmp_path)).collect():
        ids = want[r.doc_id] + [1]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start: r.start + r.length], "<u4").tobytes())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for r in corpus_pipeline.pack(spark, docs, "").collect():
        ids = want[r.doc_id] + [1]
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids[r.start: r.start + r.length]
