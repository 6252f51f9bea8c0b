"""Byte-level pre-tokens of whole Arrow batches, by numpy instead of a regex.

The split pattern of the public byte-level vocabularies
(``public_tokenizers.PATTERN``) looks at character classes and at most three
neighbouring characters, so every boundary can be decided for all characters
of a batch at once:

* letters, digits and other characters form runs; a change of class starts a
  pre-token, and one U+0020 in front belongs to the run that follows;
* white space forms runs; the last character of a run splits off when
  something follows it;
* ``'s 't 'm 'd 're 've 'll`` split off where the apostrophe starts a pre-token.

The pre-tokens cover the text without gaps, so the batch's own buffer with
the boundaries as offsets *is* the Arrow array of pre-tokens, and Arrow's
dictionary encoding finds the distinct ones exactly.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex

LETTER, DIGIT, OTHER, WHITE, SPACE = range(5)


class Split(NamedTuple):
    """``starts``: byte offset of each pre-token, then the end; ``rows``: index of each row's first pre-token, then their number; ``special``: pre-tokens that are the special string; ``kinds``: class of each pre-token's last character."""

    starts: np.ndarray
    rows: np.ndarray
    special: np.ndarray
    kinds: np.ndarray


def _every() -> str:
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


def _table(spans: dict[int, list[tuple[int, int]]]) -> np.ndarray:
    """Class by code point, from spans over the string of all characters."""
    table = np.full(0x110000 - 0x800, OTHER, np.uint8)
    for kind, found in spans.items():
        for lo, hi in found:
            table[lo:hi] = kind
    table = np.concatenate((table[:0xD800], np.full(0x800, OTHER, np.uint8), table[0xD800:]))
    table[0x20] = SPACE
    return table


@lru_cache(1)
def unicode_classes() -> np.ndarray:
    """Class of each code point by the regex library's Unicode tables."""
    every = _every()
    return _table({k: [m.span() for m in regex.finditer(p, every)] for k, p in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (WHITE, r"\s+"))})


@lru_cache(1)
def tiktoken_classes() -> np.ndarray:
    """The same by the tables inside tiktoken: libraries follow different Unicode versions.

    Characters that its pattern doesn't match are dropped, so with one class as the pattern and single bytes as ranks the rest comes back.
    """
    import tiktoken

    every = _every()
    ranks = {bytes([i]): i for i in range(256)}
    spans = {}
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (WHITE, r"\s")):
        only = tiktoken.Encoding(f"class{kind}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        kept = bytes(only.encode_ordinary(every)).decode()
        spans[kind] = [(i, i + 1) for c in kept for i in (ord(c) - 0x800 * (ord(c) >= 0xE000),)]
    return _table(spans)


@lru_cache(1)
def tokenizers_classes() -> np.ndarray:
    """The same by the tables inside tokenizers, whose byte-level pre-tokenizer has the pattern built in.

    A run of one class that it splits holds characters it knows otherwise; each piece's class is then tried beside a known character.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    table = unicode_classes().copy()
    edges = np.flatnonzero(np.diff(table)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(table)], strict=True):
        if table[lo] in (WHITE, SPACE) or table[lo] == OTHER and hi - lo > 2000:  # the latter: private use, surrogates or not assigned
            continue
        run = "".join(map(chr, (x for x in range(lo, hi) if not 0xD800 <= x < 0xE000)))
        pieces = cut(run) if run else []
        for _, (i, j) in pieces:
            c = run[i]
            kind = next((k for k, known in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")) if len(cut(known + c)) == 1), WHITE)
            for x in run[i:j]:
                table[ord(x)] = kind
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position and code point of each character of valid UTF-8."""
    if not len(data) or int(data.max()) < 0x80:
        return np.arange(len(data)), data.astype(np.int32)
    pos = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[pos].astype(np.int32)
    wide = np.flatnonzero(cp >= 0xC0)
    at, lead = pos[wide], cp[wide]
    value = np.zeros(len(wide), np.int32)
    for low, high, n, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0x100, 4, 0x07)):
        k = np.flatnonzero((lead >= low) & (lead < high))
        v = lead[k] & mask
        for j in range(1, n):
            v = (v << 6) | (data[at[k] + j].astype(np.int32) & 0x3F)
        value[k] = v
    cp[wide] = value
    return pos, cp


def find_special(data: np.ndarray, ends: np.ndarray, special: bytes) -> np.ndarray:
    """Byte positions of a special string that lie inside one row, without overlaps."""
    raw, found, at = data.tobytes(), [], 0
    while (at := raw.find(special, at)) >= 0:
        row_end = ends[np.searchsorted(ends, at, side="right")]
        if at + len(special) <= row_end:
            found.append(at)
            at += len(special)
        else:
            at += 1
    return np.array(found, np.int64)


def split(data: np.ndarray, ends: np.ndarray, special: bytes | None = None, classes: np.ndarray | None = None) -> Split:
    """Pre-tokens of rows ``data[ends[i]:ends[i + 1]]`` (valid UTF-8); ``classes``: one of the tables above."""
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Split(np.zeros(1, np.int64), np.zeros(len(ends), np.int64), none.astype(bool), none.astype(np.uint8))
    pos, cp = code_points(data)
    kind = (unicode_classes() if classes is None else classes)[cp]
    n = len(pos)
    space = kind == SPACE
    run = np.where(space, np.uint8(WHITE), kind)
    white = run == WHITE
    hard = np.zeros(n + 1, bool)  # a text, or a part between special strings, starts here
    char_at = lambda byte: np.searchsorted(pos, byte)
    hard[char_at(ends)] = True
    hard[[0, n]] = True
    marks = find_special(data, ends, special) if special else np.zeros(0, np.int64)
    if len(marks):
        first, last = char_at(marks), char_at(marks + len(special))
        hard[first] = True
        hard[last] = True
    start = hard[:n].copy()
    before = np.empty_like(run)
    before[0], before[1:] = WHITE, run[:-1]
    after_space = np.zeros(n, bool)
    after_space[1:] = space[:-1]
    start |= ~white & (run != before) & ~after_space
    follows = np.zeros(n, bool)  # something other than white space follows in the same text
    follows[:-1] = ~white[1:]
    follows &= ~hard[1:]
    start |= white & ((before != WHITE) | follows)
    # contractions
    quote = np.flatnonzero((cp == 0x27) & start)
    if len(quote):
        pad = np.concatenate((cp, [0, 0]))
        stop = np.concatenate((hard, [True, True]))
        one, two = pad[quote + 1], pad[quote + 2]
        in1 = ~stop[quote + 1]
        in2 = in1 & ~stop[quote + 2]
        short = in1 & np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))]
        long = in2 & np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])
        start = np.concatenate((start, [True, True, True]))
        for which, width in ((short, 1), (long, 2)):
            q = quote[which]
            start[q + 1] = False
            if width == 2:
                start[q + 2] = False
            start[q + 1 + width] = True
        start = start[:n]
    if len(marks):
        inside = np.zeros(n + 1, np.int8)
        np.add.at(inside, first + 1, 1)
        np.add.at(inside, last, -1)
        start &= ~(np.cumsum(inside[:n]) > 0)
        start[first] = True
    chars = np.flatnonzero(start)
    starts = np.append(pos[chars], size)
    rows = np.searchsorted(starts[:-1], ends)
    is_special = np.zeros(len(chars), bool)
    if len(marks):
        is_special[np.searchsorted(starts, marks)] = True
    last_char = np.append(chars[1:], n) - 1
    return Split(starts, rows, is_special, run[last_char])


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """For each pre-token its number among the distinct ones; the distinct ones."""
    whole = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = whole.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary
