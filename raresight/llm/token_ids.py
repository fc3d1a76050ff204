"""Ids of the public ``tokenizers`` vocabulary, one call per distinct piece of text.

The library's byte-level pre-tokeniser cuts a text by the public pattern and encodes every piece
by itself, so encoding each distinct piece once per worker gives the library's ids for whole texts.
Strings of added tokens (``<|endoftext|>``) are ordinary text unless ``added`` is set; then each is its own
id and the text is cut there first, as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` does.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from raresight.llm.pretokens import PieceIds, Pieces

_STORES: dict[str, PieceIds] = {}
_ADDED: dict[str, dict[str, int]] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def store(path: str) -> PieceIds:
    if path not in _STORES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        if special:
            tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        _STORES[path] = PieceIds(lambda pieces: [e.ids for e in tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)])
    return _STORES[path]


def added_tokens(path: str) -> dict[str, int]:
    """String -> id of the vocabulary's added tokens."""
    if path not in _ADDED:
        from tokenizers import Tokenizer

        tokens = Tokenizer.from_file(path).get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens.values()):
            raise ValueError("added tokens that look at the text around them are not supported")
        _ADDED[path] = {t.content: i for i, t in tokens.items()}
    return _ADDED[path]


def cut_at_added(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids per text) where added tokens' strings are ids of their own."""
    tokens = added_tokens(path)
    has = np.zeros(len(column), bool)
    for t in tokens:
        has |= pc.fill_null(pc.match_substring(column, t), False).to_numpy(zero_copy_only=False)
    if not has.any():
        ids, counts, _ = store(path).ids(Pieces(column))
        return ids, counts
    at = re.compile("(" + "|".join(re.escape(t) for t in sorted(tokens, key=len, reverse=True)) + ")")
    parts, behind, first = [], [], []  # ordinary texts, the id behind each (or -1), the first part of each row
    for text, cut in zip(column.to_pylist(), has):
        found = at.split(text) if cut else [text]
        first.append(len(parts))
        parts += found[::2]
        behind += [tokens[t] for t in found[1::2]] + [-1]
    ids, counts, _ = store(path).ids(Pieces(pa.array(parts, column.type)))
    own = np.array(behind)
    ids = np.insert(ids, np.cumsum(counts)[own >= 0], own[own >= 0])
    return ids, np.add.reduceat(counts + (own >= 0), first)


def encode_column(column: pa.Array, path: str, last_id: int | None = None, added: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, number of ids per text); ``last_id`` is added to every text."""
    if added:
        ids, counts = cut_at_added(column, path)
    else:
        ids, counts, _ = store(path).ids(Pieces(column))
    if last_id is None:
        return ids, counts
    ends = np.cumsum(counts)
    return np.insert(ids, ends, last_id).astype(np.int32), counts + 1
