"""Token counts of whole texts by rank-synchronous merging.

The merges of a byte-level BPE are applied to many pre-tokens at once.  The
distinct pre-tokens of a slice of an Arrow batch lie in one flat symbol array
with ragged bounds.  In each round every sequence finds its pair of lowest
rank (``minimum.reduceat``), all sequences merge theirs (from the left, without
overlap), the array is compacted, and finished sequences leave.  What is left
of a sequence is its number of tokens.

Merging all places of a sequence's lowest-rank pair in one round equals
merging them one by one: a pair that a merge creates contains the new symbol,
whose own pairs all have a higher rank.

A text's count is the sum over its pre-tokens; an added token of the
vocabulary (``<|endoftext|>``) inside a text counts as one token, as the
library's default has it.

Defined results: a null or empty text has 0 bytes and 0 tokens; each input row
gives one output row, equal or null ids included; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.llm import pretokens
from inkline.llm.columnar import ragged, slices, sums_by_row, text_buffer

NONE = np.int32(2**31 - 1)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Bytes that are printable in Latin-1 stand for themselves; the others take the code points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Merges:
    """Pair -> (rank, new symbol), as an open-addressing table in numpy."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.made = made
        self.bits = max(10, int(np.ceil(np.log2(max(1, len(merges)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        todo, keys = np.arange(len(merges)), (left << 32) | right
        slot = self._slot(keys)
        while len(todo):  # all that still look for a free slot try theirs; the first of each slot gets it
            free = self.keys[slot[todo]] < 0
            _, first = np.unique(slot[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[slot[won]], self.ranks[slot[won]] = keys[won], won
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where no merge joins it."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((there >= 0) & (there != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[(there >= 0) & ~hit]
        return out


@lru_cache(2)
def load(vocab_file: str) -> tuple[Merges, bytes | None]:
    """Merges and the added special string of a tokenizers file, each loaded once per worker."""
    with open(vocab_file, encoding="utf-8") as f:
        spec = json.load(f)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    added = [x["content"] for x in spec.get("added_tokens", [])]
    if len(added) > 1:
        raise ValueError("one added token at most is supported")
    return Merges(spec["model"]["vocab"], pairs), added[0].encode() if added else None


def merge_lengths(merges: Merges, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols left of each byte sequence ``data[ends[i]:ends[i + 1]]`` after all merges."""
    out = np.diff(ends).astype(np.int64)
    live = np.flatnonzero(out > 1)  # sequences that may still merge
    sym = merges.byte_ids[data[ragged(ends[live], out[live])]]
    size = out[live]
    begin = np.cumsum(size) - size
    last = np.zeros(len(sym), bool)
    last[begin + size - 1] = True
    rank = np.full(len(sym), NONE, np.int32)
    at = np.flatnonzero(~last)
    rank[at] = merges.rank(sym[at], sym[at + 1])
    while len(live):
        low = np.minimum.reduceat(rank, begin)
        going = low < NONE
        if not going.all():  # finished sequences leave
            out[live[~going]] = size[~going]
            keep = ragged(begin[going], size[going])
            sym, rank, last = sym[keep], rank[keep], last[keep]
            live, size, low = live[going], size[going], low[going]
            begin = np.cumsum(size) - size
            if not len(live):
                break
        hit = np.flatnonzero(rank == np.repeat(low, size))
        # of places that overlap (a a a), every second from the left: places count from the start of their chain
        chain = np.ones(len(hit), bool)
        chain[1:] = (np.diff(hit) > 1) | last[hit[:-1]]
        order = np.arange(len(hit))
        hit = hit[(order - np.maximum.accumulate(np.where(chain, order, 0))) % 2 == 0]
        sym[hit] = merges.made[rank[hit]]
        last[hit] = last[hit + 1]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        size = size - np.bincount(np.searchsorted(begin, hit, side="right") - 1, minlength=len(size))
        now = np.cumsum(keep) - 1
        sym, rank, last, spot = sym[keep], rank[keep], last[keep], now[hit]
        begin = np.cumsum(size) - size
        changed = np.zeros(len(sym), bool)
        changed[spot] = True
        changed[np.maximum(spot - 1, 0)] = True
        touched = np.flatnonzero(changed)
        touched_last = last[touched]
        rank[touched[touched_last]] = NONE
        at = touched[~touched_last]
        rank[at] = merges.rank(sym[at], sym[at + 1])
    return out


def count_tokens(texts: pa.Array, vocab_file: str) -> np.ndarray:
    """Tokens of each text of an Arrow array."""
    merges, special = load(vocab_file)
    out = [np.zeros(0, np.int64)]
    for lo, hi in slices(texts):
        data, ends = text_buffer(texts.slice(lo, hi - lo))
        cut = pretokens.split(data, ends, special, pretokens.tokenizers_classes())
        which, words = pretokens.distinct(data, cut.starts)
        word_data, word_ends = text_buffer(words)
        tokens = merge_lengths(merges, word_data, word_ends)[which] if len(words) else np.zeros(0, np.int64)
        tokens[cut.special] = 1
        out.append(sums_by_row(tokens, cut.rows))
    return np.concatenate(out)


def token_counts(docs: DataFrame, vocab_file: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit.  A projection of the scan; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = count_tokens(b.column(1), vocab_file)
            _, ends = text_buffer(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends)), pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_col)
