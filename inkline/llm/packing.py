"""Packing of documents into training sequences by sum of squares.

A document's ids are cut into whole windows, which fill a sequence each, and
a rest.  Rests are placed online: a level array counts the partially filled
sequences of each fill level, and a rest goes where the sum of the squared
counts becomes smallest (ties: to the fuller sequence).  That keeps the levels
evenly occupied, so a rest finds a sequence that it closes.

Each Spark partition packs its own rows, in their order, so nothing is
shuffled and a task that runs again gives the same sequences (their ids hold
the partition's number).  What is still open at the end of a partition, or
when ``max_open`` sequences are open, is closed by cutting: the emptiest
sequence's pieces fill the fullest one.  So at most one sequence of a
partition is padded, and memory is bounded by ``max_open`` windows.

Defined results: a null or empty text is a document of the end id alone; each
row is a document of its own, equal or null ids included; no rows give no
pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.llm.columnar import trimmed
from inkline.llm.piece_codec import from_json

COLUMNS = ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Piece(NamedTuple):
    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int


class Packer:
    """Level array and open sequences of one partition; ``done`` holds closed sequences (lists of pieces)."""

    def __init__(self, window: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.level = np.zeros(window, np.int64)  # open sequences by fill level; 0 is unused
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def place(self, piece: Piece) -> None:
        size, n = len(piece.ids), self.level
        # change of the sum of squares by fill level h: h loses one and h + size gains one; a full sequence counts no more
        best, level = 2 * n[size] + 1, 0
        here = n[1:self.window - size]
        if len(here):
            change = np.where(here > 0, 2 * (n[1 + size:] - here + 1), np.iinfo(np.int64).max)
            h = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[h] <= best and here[h]:
                best, level = change[h], h + 1
        close = self.window - size
        if n[close] and 1 - 2 * n[close] <= best:
            level = close
        pieces = []
        if level:
            pieces = self.open[level].pop()
            n[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + size == self.window:
            self.done.append(pieces)
        else:
            self.open[level + size].append(pieces)
            n[level + size] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                self.settle(keep=1)

    def add(self, doc: object, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.done.append([Piece(doc, at, ids[at:at + self.window], len(ids))])
        if len(ids) > whole:
            self.place(Piece(doc, whole, ids[whole:].copy(), len(ids)))  # a copy: the slice's array needn't stay

    def settle(self, keep: int = 0) -> None:
        """Close the open sequences by cutting; one that can't be filled stays open, or is closed as it is."""
        queue = deque((level, pieces) for level in range(self.window - 1, 0, -1) for pieces in self.open[level])
        self.level[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.n_open = 0
        while queue:
            fill, pieces = queue.popleft()
            while fill < self.window and queue:
                have, givers = queue.pop()
                need = self.window - fill
                while givers and need:
                    p = givers.pop()
                    if len(p.ids) > need:
                        pieces.append(Piece(p.doc, p.start, p.ids[:need], p.doc_tokens))
                        givers.append(Piece(p.doc, p.start + need, p.ids[need:], p.doc_tokens))
                        have, fill, need = have - need, self.window, 0
                    else:
                        pieces.append(p)
                        have, fill, need = have - len(p.ids), fill + len(p.ids), need - len(p.ids)
                if givers:
                    queue.append((have, givers))
            if fill == self.window or not keep:
                self.done.append(pieces)
            else:
                self.open[fill].append(pieces)
                self.level[fill] += 1
                self.n_open += 1


def pack(docs: DataFrame, vocab_file: str, window: int = 1024, end_id: int = 0, with_ids: bool = False, max_open: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids where asked for."""
    if window < 2:
        raise ValueError("window must be 2 at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, packer = from_json(vocab_file), Packer(window, max_open)
        sequence = TaskContext.get().partitionId() << 33
        kinds = [pa.int64()] * 7  # the first is the id's own

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows, ids = [], []
            for pieces in packer.done:
                at = 0
                for p in pieces:
                    raw = p.ids.astype("<u4").tobytes()
                    rows.append((p.doc, p.start, len(p.ids), zlib.crc32(raw), p.doc_tokens, sequence, at))
                    if with_ids:
                        ids.append(p.ids)
                    at += len(p.ids)
                sequence += 1
            packer.done = []
            if rows:
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], [*COLUMNS, *["ids"] * with_ids])

        for b in batches:
            kinds[0] = b.column(0).type
            for s in codec.slices(b.column(1)):
                for doc, lo, hi in zip(b.column(0).slice(s.lo, s.hi - s.lo).to_pylist(), s.rows[:-1], s.rows[1:], strict=True):
                    packer.add(doc, np.append(s.ids[lo:hi], np.int32(end_id)))
                yield from flush()
        packer.settle()
        yield from flush()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(trimmed(run), schema)
    return out.withColumnRenamed("id", id_col)
