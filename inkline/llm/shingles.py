"""Word-shingle sets and their MinHash tries, over slices of Arrow batches.

Words are what white space (U+0020, U+0009 to U+000D) separates; a shingle is
five words in a row, and a text of one to four words has one shingle, all its
words.  Shingles are 64-bit hashes (XXH3 of each word, then mixed), so sets
compare as sorted integer arrays.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

from inkline.llm.columnar import text_buffer
from inkline.llm.pretokens import distinct

WIDTH = 5
#: Tries, and the steps of a path that a key holds: 40 bits for the first five together, 12 for each of two more.
TREES, SHORT, LONG = 40, 5, 7
STEP_BITS = 12

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(1 << 62, size=(TREES, LONG), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
C1, C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


class Sets(NamedTuple):
    """Shingle hashes of all rows (not yet distinct), and the index of each row's first one (rows + 1)."""

    hashes: np.ndarray
    rows: np.ndarray


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * C1
        h = (h ^ (h >> np.uint64(33))) * C2
        return h ^ (h >> np.uint64(33))


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word; index of each row's first word (rows + 1)."""
    n = len(data)
    blank = (data == 0x20) | (data >= 9) & (data <= 13)
    edge = np.zeros(n + 1, bool)
    edge[1:n] = blank[1:] != blank[:-1]
    edge[ends] = True
    edge[[0, n]] = True
    starts = np.flatnonzero(edge)
    which, names = distinct(data, starts)
    raw = names.to_pylist()
    table = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in raw), np.uint64, len(raw))
    word = ~blank[starts[:-1]]
    return table[which[word]], np.append(0, np.cumsum(word))[np.searchsorted(starts, ends)]


def shingle_sets(texts: pa.Array) -> Sets:
    data, ends = text_buffer(texts)
    if not len(data):
        return Sets(np.zeros(0, np.uint64), np.zeros(len(ends), np.int64))
    words, rows = _words(data, ends)
    count = np.diff(rows)
    size = np.where(count >= WIDTH, count - WIDTH + 1, np.minimum(count, 1))
    at = np.repeat(rows[:-1] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    length = np.repeat(np.minimum(count, WIDTH), size)
    h = np.zeros(len(at), np.uint64)
    for k in range(WIDTH):
        with np.errstate(over="ignore"):
            more = mixed(h * C2 + words[np.minimum(at + k, len(words) - 1)])
        h = np.where(k < length, more, h)
    return Sets(h, np.append(0, np.cumsum(size)))


def trie_keys(sets: Sets) -> np.ndarray:
    """For each row with shingles (in order) its path in each trie, as one sortable integer: a shorter prefix is a right shift."""
    some = np.flatnonzero(np.diff(sets.rows))
    begin = sets.rows[:-1][some]
    keys = np.zeros((len(some), TREES), np.uint64)
    if not len(some):
        return keys
    for t in range(TREES):
        path = np.full(len(some), t, np.uint64)
        for d in range(LONG):
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat((sets.hashes * FACTORS[t, d]) >> np.uint64(16), begin)
            step = mixed(least)
            if d < SHORT:
                with np.errstate(over="ignore"):
                    path = mixed(path * C2 + step)
                if d == SHORT - 1:
                    path >>= np.uint64(64 - (63 - STEP_BITS * (LONG - SHORT)))
            else:
                path = (path << np.uint64(STEP_BITS)) | (step >> np.uint64(64 - STEP_BITS))
        keys[:, t] = path
    return keys
