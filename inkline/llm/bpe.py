"""Byte-level BPE encoding and decoding over Arrow batches.

``bpe_encode`` gives ids and character offsets of every text; ``bpe_decode``
reverses the byte table.  The vocabulary file holds ranks; its path is a
parameter and must be readable on the executors.

Characters split over tokens: decoding joins the bytes of all ids of a row
before it reads them as UTF-8, so a character whose bytes lie in several ids
comes back whole.  ``pieces`` (the text of each id alone) gives such a
character to the id that completes it, and '' to those before.  Bytes that
are no UTF-8 (ids cut out of a sequence) become U+FFFD in ``text``, never in
``bytes``.

Defined results: null or empty text, or a null list of ids, gives no ids and
empty text; each input row gives one output row, equal or null ids of rows
included; an id outside the vocabulary raises IndexError; other columns are
not read.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.llm.columnar import trimmed
from inkline.llm.piece_codec import Codec, from_ranks


def _lists(values: np.ndarray, rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(values.astype(np.int32)))


def bpe_encode(docs: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids, char_start and char_end of each token (arrays of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = from_ranks(rank_file)
        for b in batches:
            for s in codec.slices(b.column(1)):
                begin, end = codec.offsets(s.ids, s.data, s.ends, s.rows)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s.lo, s.hi - s.lo), *(_lists(x, s.rows) for x in (s.ids, begin, end))], ["id", "ids", "char_start", "char_end"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(trimmed(run), f"id {kind}, ids array<int>, char_start array<int>, char_end array<int>")
    return out.withColumnRenamed("id", id_col)


def pieces(codec: Codec, ids: np.ndarray) -> list[str]:
    """Text of each id alone, a split character at the id that completes it."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    raw = [codec.table[codec.begins[i]:codec.begins[i] + codec.lengths[i]].tobytes() for i in ids]
    return [reader.decode(x, final=k == len(raw) - 1) for k, x in enumerate(raw)]


def bpe_decode(encoded: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids", with_pieces: bool = False) -> DataFrame:
    """Per row: id, bytes, text, and the text of each id where asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = from_ranks(rank_file)
        for b in batches:
            lists = pc.fill_null(b.column(1), pa.scalar([], b.column(1).type))
            flat, rows = lists.flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
            if len(flat) and (flat.min() < 0 or flat.max() >= len(codec.lengths)):
                raise IndexError("an id is outside the vocabulary")
            data, ends = codec.decode(flat, rows)
            raw = [data[lo:hi].tobytes() for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            columns = [b.column(0), pa.array(raw, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())]
            if with_pieces:
                columns.append(pa.array([pieces(codec, flat[lo:hi]) for lo, hi in zip(rows[:-1], rows[1:], strict=True)], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, ["id", "bytes", "text", "pieces"][:len(columns)])

    kind = encoded.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, bytes binary, text string" + ", pieces array<string>" * with_pieces
    out = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(trimmed(run), schema)
    return out.withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the bytes they decode to.

    Encodes and decodes in one pass, so that the ids of a whole corpus needn't travel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = from_ranks(rank_file)
        for b in batches:
            for s in codec.slices(b.column(1)):
                data, ends = codec.decode(s.ids, s.rows)
                ids = s.ids.astype("<u4")
                digest = lambda a, cuts: [hashlib.sha256(a[lo:hi]).hexdigest() for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s.lo, s.hi - s.lo), pa.array(np.diff(s.rows)), pa.array(digest(ids, s.rows)), pa.array(digest(data, ends))], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(trimmed(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
