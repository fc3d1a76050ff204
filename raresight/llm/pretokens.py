"""Pre-tokenisation without a regular expression.

Every code point gets a class (letter, number, other, blank, other white space, or an apostrophe
that a contraction may begin).  A class is a function from the state before the code point to the
state after it; composition of such functions is associative, and the functions that can arise
form a small finite set.  So a prefix scan over function numbers (table look-ups, many texts at
once) gives the state before every code point, and the states give the piece boundaries of the
public byte-level BPE pattern.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa

from raresight.llm.common import utf8

# classes of code points
LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE1, QUOTE2 = range(7)
# states: kind of the last code point; one or two letters of a contraction still to come; fresh start
S_LETTER, S_NUMBER, S_OTHER, S_BLANK, S_SPACE, S_MORE1, S_MORE2, S_FRESH = range(8)

# The white space code points of the pattern's \s, and its contractions' letters.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER = "stmd"
TWO_LETTERS = ["re", "ve", "ll"]
SHORT_MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)], np.uint64)


def after(state: int, kind: int) -> int:
    if kind == LETTER:
        return {S_MORE2: S_MORE1, S_MORE1: S_FRESH}.get(state, S_LETTER)
    if kind in (QUOTE1, QUOTE2):  # a contraction begins only where a piece begins
        if state in (S_OTHER, S_BLANK):
            return S_OTHER
        return S_MORE1 if kind == QUOTE1 else S_MORE2
    return {NUMBER: S_NUMBER, OTHER: S_OTHER, BLANK: S_BLANK, SPACE: S_SPACE}[kind]


def begins(state: int, kind: int) -> bool:
    """Does a piece begin at a code point of this kind?  (White space is judged by its neighbours as well.)"""
    glued = {LETTER: (S_LETTER, S_BLANK, S_MORE1, S_MORE2), NUMBER: (S_NUMBER, S_BLANK),
             BLANK: (S_BLANK, S_SPACE), SPACE: (S_BLANK, S_SPACE)}.get(kind, (S_OTHER, S_BLANK))
    return state not in glued


@lru_cache(1)
def machine():
    """(function of a class, function of a text's first class, composition table, application table)."""
    identity = tuple(range(8))
    plain = [tuple(after(s, k) for s in range(8)) for k in range(7)]
    first = [tuple([after(S_FRESH, k)] * 8) for k in range(7)]
    known = {identity: 0}
    queue = [identity]
    for f in queue:  # grows while it is read: the closure under composition
        for g in [*plain, *first]:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    members = list(known)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in members] for f in members], np.uint8)
    apply = np.array(members, np.uint8)
    begin = np.array([[begins(s, k) for k in range(7)] for s in range(8)])
    return np.array([known[f] for f in plain], np.uint8), np.array([known[f] for f in first], np.uint8), compose, apply, begin


@lru_cache(1)
def class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(c))[0])
        if kind is not None:
            table[c] = kind
    table[WHITE_SPACE] = SPACE
    table[0x20] = BLANK
    return table


def codepoints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, value) of every code point of valid UTF-8."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    value = data[lead].astype(np.int32)
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
        at = np.flatnonzero((value >= low) & (value < high) & (value < 0x100)) if more == 1 else np.flatnonzero((data[lead] >= low) & (data[lead] < high))
        if len(at):
            x = data[lead[at]].astype(np.int32) & (0x3F >> more)
            for j in range(1, more + 1):
                x = (x << 6) | (data[lead[at] + j] & 0x3F)
            value[at] = x
    return lead, value


def prefix_states(functions: np.ndarray) -> np.ndarray:
    """State before every position, by an associative scan of function numbers in columns."""
    _, _, compose, apply, _ = machine()
    n, m = len(functions), compose.shape[0]
    flat = compose.ravel()
    width = 256
    rows = -(-n // width)
    columns = np.zeros(rows * width, np.uint8)
    columns[:n] = functions
    columns = np.ascontiguousarray(columns.reshape(rows, width).T)
    before = np.empty_like(columns)
    total = np.zeros(rows, np.uint8)
    for j in range(width):  # all rows one step at a time
        before[j] = total
        total = flat[total.astype(np.int32) * m + columns[j]]
    scan = np.concatenate([[np.uint8(0)], total[:-1]])  # exclusive scan over rows by doubling
    step = 1
    while step < rows:
        scan[step:] = flat[scan[:-step].astype(np.int32) * m + scan[step:]]
        step *= 2
    start = apply[scan, S_FRESH]
    return apply[before, start[None, :]].T.reshape(-1)[:n]


class Pieces:
    """Pieces of a column of texts: byte offsets of all pieces and the number of pieces per text."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        self.data, self.text_offsets = data, offsets
        if not len(data):
            self.starts, self.counts = np.zeros(0, np.int64), np.zeros(len(column), np.int64)
            return
        lead, value = codepoints(data)
        kind = class_table()[value]
        first = np.searchsorted(lead, offsets[:-1][np.diff(offsets) > 0])  # first code point of each text
        is_first = np.zeros(len(lead) + 2, bool)
        is_first[first] = True
        is_first[len(lead):] = True  # beyond the last text
        quotes = np.flatnonzero(value == 0x27)
        if len(quotes):
            padded = np.concatenate([value, [0, 0]])
            inside1 = ~is_first[quotes + 1]
            one = inside1 & np.isin(padded[quotes + 1], [ord(c) for c in ONE_LETTER])
            two = np.zeros(len(quotes), bool)
            near = np.where(inside1, ~is_first[np.minimum(quotes + 2, len(lead) + 1)], False)
            for a, b in TWO_LETTERS:
                two |= near & (padded[quotes + 1] == ord(a)) & (padded[quotes + 2] == ord(b))
            kind[quotes[one]] = QUOTE1
            kind[quotes[two]] = QUOTE2
        plain, head, _, _, begin = machine()
        functions = plain[kind]
        functions[first] = head[kind[first]]
        state = prefix_states(functions)
        state[first] = S_FRESH
        start = begin[state, kind]
        white = (kind == BLANK) | (kind == SPACE)
        last = np.ones(len(lead), bool)
        last[:-1] = ~white[1:]
        # the last white space of a run begins a piece when a non-space of the same text follows
        start |= white & last & ~is_first[1:len(lead) + 1]
        chosen = np.flatnonzero(start)
        self.starts = lead[chosen]
        self.counts = np.diff(np.searchsorted(self.starts, offsets))

    def distinct(self) -> tuple[np.ndarray, list[bytes]]:
        """(number of each piece's value, the values).  Pieces of up to seven bytes are compared as
        one integer (bytes and length), longer ones by Arrow's dictionary."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int64), []
        ends = np.append(self.starts[1:], len(self.data))
        length = ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data),), "<u8", padded, 0, (1,))  # the eight bytes from each place on
        short = length <= 7
        keys = (eight[self.starts[short]] & SHORT_MASK[length[short]]) | (length[short].astype(np.uint64) << np.uint64(56))
        codes, unique = pd.factorize(keys)
        raw = unique.astype("<u8").tobytes()
        values = [raw[i: i + raw[i + 7]] for i in range(0, len(raw), 8)]
        index = np.empty(n, np.int64)
        index[short] = codes
        if not short.all():
            # the column of longer pieces: only their bytes, one after the other
            inside = np.repeat(~short, length)
            offsets = np.concatenate([[0], np.cumsum(length[~short])]).astype(np.int32)
            column = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(self.data[inside])])
            coded = column.dictionary_encode()
            index[~short] = coded.indices.to_numpy().astype(np.int64) + len(values)
            values += coded.dictionary.to_pylist()
        return index, values


class PieceIds:
    """Ids of pieces, kept over batches.  ``encode`` maps unseen pieces to lists of ids.

    The store holds at most ``limit`` pieces and starts anew beyond that: memory is bounded, and
    only repeated work is lost.
    """

    def __init__(self, encode, limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.flat, self.ends, self.used = np.zeros(1 << 16, np.int32), np.zeros((1 << 14) + 1, np.int64), 0

    def add(self, pieces: list[bytes]) -> None:
        found = self.encode(pieces)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        n, end = len(self.known), self.used + int(lengths.sum())
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(found) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used:end] = np.fromiter((i for ids in found for i in ids), np.int32, end - self.used)
        self.ends[n + 1: n + 1 + len(found)] = self.used + np.cumsum(lengths)
        self.known.update(zip(pieces, range(n, n + len(found))))
        self.used = end

    def ids(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text, number of ids per piece)."""
        index, values = pieces.distinct()
        if len(self.known) > self.limit:
            self.clear()
        fresh = [v for v in values if v not in self.known]
        if fresh:
            self.add(fresh)
        if not values:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.int32), np.zeros(len(pieces.counts), np.int64), none
        number = np.fromiter((self.known[v] for v in values), np.int64, len(values))[index]
        begin = self.ends[number]
        length = self.ends[number + 1] - begin
        ahead = np.cumsum(length) - length
        where = np.repeat(begin - ahead, length)
        where += np.arange(len(where))
        bounds = np.concatenate([[0], np.cumsum(length)])
        text = np.concatenate([[0], np.cumsum(pieces.counts)])
        return self.flat[where], np.diff(bounds[text]), length
