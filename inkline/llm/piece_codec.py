"""Byte-level BPE ids through the ``tokenizers`` library, over Arrow batches.

A text is split into pre-tokens, each distinct pre-token goes through the
library once (and stays in a bounded store of the worker), and the ids are
scattered back with numpy.  The ids of a text are the ids of its pre-tokens
in order, so this equals one library call per text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from inkline.llm import pretokens
from inkline.llm.columnar import ragged, slices, sums_by_row, text_buffer
from inkline.llm.token_counts import byte_alphabet

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core

#: Distinct pre-tokens that a worker keeps; beyond, the half used last stays. Bounds its memory, not its results.
STORE = 300_000
#: Words of one call of the library.
CALL = 4_000


class Encoded(NamedTuple):
    """Rows ``lo`` to ``hi``: their ids, the index of each row's first id (rows + 1), their bytes and byte offsets."""

    lo: int
    hi: int
    ids: np.ndarray
    rows: np.ndarray
    data: np.ndarray
    ends: np.ndarray


class Codec:
    """One vocabulary: a ``tokenizers`` model that sees one pre-token at a time, and the bytes of each id."""

    def __init__(self, tokenizer, token_bytes: list[bytes], classes: np.ndarray, special: tuple[bytes, int] | None):
        self.tokenizer, self.classes, self.special = tokenizer, classes, special
        lengths = np.array([len(t) for t in token_bytes], np.int64)
        self.table = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.lengths, self.begins = lengths, np.cumsum(lengths) - lengths
        self._clear()

    def _clear(self) -> None:
        self.words = pa.array([], pa.binary())  # what is held; its ids lie from ``first`` on in ``store``, and ``used`` is the slice that last used it
        self.store, self.end = np.zeros(1 << 20, np.int32), 0
        self.first, self.count, self.used = (np.zeros(2 * STORE, np.int32) for _ in range(3))
        self.turn = 0

    def _room(self, words: int, ids: int) -> None:
        """Arrays grow by doubling, and rarely, so that a worker's memory isn't cut to pieces."""
        if self.end + ids > len(self.store):
            self.store = np.concatenate((self.store, np.zeros(max(len(self.store), ids), np.int32)))
        if len(self.words) + words > len(self.first):
            more = np.zeros(max(len(self.first), words), np.int32)
            self.first, self.count, self.used = (np.concatenate((x, more)) for x in (self.first, self.count, self.used))

    def _learn(self, words: pa.Array) -> None:
        """Ids of unknown words, a few thousand in one call of the library."""
        at = len(self.words)
        self._room(len(words), 0)
        for lo in range(0, len(words), CALL):
            part = words.slice(lo, CALL)
            found = self.tokenizer.encode(part.cast(pa.string()).to_pylist(), is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, np.int32)
            sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(part))
            self._room(0, len(ids))
            here = slice(at + lo, at + lo + len(part))
            self.first[here], self.count[here], self.used[here] = self.end + np.cumsum(sizes) - sizes, sizes, self.turn
            self.store[self.end:self.end + len(ids)] = ids
            self.end += len(ids)
        if len(words):
            self.words = pa.concat_arrays([self.words, words])

    def _shrink(self) -> None:
        """Keep the words used last, half of ``STORE``."""
        n = len(self.words)
        kept = np.sort(np.argsort(self.used[:n], kind="stable")[-(STORE // 2):])
        self.words, m = self.words.take(pa.array(kept)), len(kept)
        ids = self.store[ragged(self.first[kept].astype(np.int64), self.count[kept].astype(np.int64))]
        self.count[:m], self.used[:m] = self.count[kept], self.used[kept]
        self.first[:m] = np.cumsum(self.count[:m]) - self.count[:m]
        self.end = len(ids)
        self.store[:self.end] = ids

    def _slots(self, words: pa.Array) -> np.ndarray:
        """Place of each of the distinct ``words`` in the store; the special string has none, and gets any."""
        if len(self.words) > STORE:
            self._shrink()
        self.turn += 1
        found = pc.index_in(words, value_set=self.words)
        unknown = found.is_null().to_numpy(zero_copy_only=False)
        slot = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).copy()
        self.used[slot[~unknown]] = self.turn
        if self.special:
            unknown &= ~pc.equal(words, self.special[0]).to_numpy(zero_copy_only=False)
        slot[unknown] = len(self.words) + np.arange(unknown.sum())
        self._learn(words.filter(pa.array(unknown)))
        return slot

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows ``data[ends[i]:ends[i + 1]]``, and the index of each row's first id."""
        cut = pretokens.split(data, ends, self.special[0] if self.special else None, self.classes)
        if len(cut.starts) == 1:
            return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
        which, words = pretokens.distinct(data, cut.starts)
        slot = self._slots(words)[which]
        marks = np.flatnonzero(cut.special)
        if not len(self.words):  # nothing but special strings so far
            return np.full(len(marks), self.special[1], np.int32), cut.rows
        first, count = self.first[slot].astype(np.int64), self.count[slot].astype(np.int64)
        first[marks], count[marks] = 0, 1
        place = np.cumsum(count) - count
        ids = self.store[ragged(first, count)]
        if len(marks):
            ids[place[marks]] = self.special[1]
        return ids, np.append(place, len(ids))[cut.rows]

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids by the reversed byte table, and the byte offset of each row."""
        size = self.lengths[ids]
        return self.table[ragged(self.begins[ids], size)], np.append(0, np.cumsum(sums_by_row(size, rows)))

    def offsets(self, ids: np.ndarray, data: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token and the one after its last, within its text.

        Bytes map to the character they belong to, so a token that holds only part of a character covers that character, as do the other tokens that hold the rest.
        """
        size = self.lengths[ids]
        begin = np.cumsum(size) - size
        lead = (data & 0xC0) != 0x80
        char = np.cumsum(lead) - 1  # of each byte, in the whole slice
        base = np.append(char, len(np.flatnonzero(lead)))[ends[:-1]] if len(data) else np.zeros(len(ends) - 1, np.int64)
        shift = np.repeat(base, np.diff(rows))
        return char[begin] - shift, char[begin + size - 1] + 1 - shift

    def slices(self, texts: pa.Array) -> Iterator[Encoded]:
        for lo, hi in slices(texts):
            data, ends = text_buffer(texts.slice(lo, hi - lo))
            ids, rows = self.encode(data, ends)
            yield Encoded(lo, hi, ids, rows, data, ends)


@lru_cache(2)
def from_ranks(rank_file: str) -> Codec:
    """Codec of a file of ranks: a pair merges wherever its joined bytes have a rank, the lowest rank first.

    The library wants the pairs themselves: all ways to cut each token into two tokens, in order of rank.
    """
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 ... without gaps")
    letters = byte_alphabet()
    shown = lambda token: "".join(letters[b] for b in token)
    tokens = sorted(ranks, key=ranks.__getitem__)
    pairs = [(shown(t[:k]), shown(t[k:])) for t in tokens for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    model = BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=pairs, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    return Codec(tokenizer, tokens, pretokens.tiktoken_classes(), None)


@lru_cache(2)
def from_json(vocab_file: str) -> Codec:
    """Codec of a tokenizers file with a byte-level BPE; its added token inside a text is one id."""
    import json

    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(vocab_file)
    tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    if len(added) > 1:
        raise ValueError("one added token at most is supported")
    with open(vocab_file, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    tokens: list[bytes] = [b""] * (max([*vocab.values(), *added]) + 1)
    for shown, i in vocab.items():
        tokens[i] = added[i] if i in added else bytes(byte_of[c] for c in shown)
    for i, raw in added.items():
        tokens[i] = raw
    return Codec(tokenizer, tokens, pretokens.tokenizers_classes(), next(((t, i) for i, t in added.items()), None))
