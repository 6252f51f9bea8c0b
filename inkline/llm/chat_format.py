"""Chat formatting by columnar byte assembly, and the reader that checks it.

Template of a turn: ``<|im_start|>role``, a line end, the text, ``<|im_end|>``
and a line end.  The bytes of a slice of turns are put together at once:
segment lengths (header, text, trailer of each turn), their cumulative
offsets, and scatter indices in numpy; one preallocated Arrow buffer takes the
copy.  The loss mask is a list of byte spans, one for each assistant text.

Control strings inside texts and roles (``CONTROL``) are escaped by a
backslash after their first character; one that already has backslashes there
gets one more, so reading drops exactly one and the escape is reversible.  A
line end in a role becomes ``\\n``, and a backslash there is doubled.

Turns are range-partitioned on (conversation, turn), so a conversation with
very many turns is spread over tasks; its output is several blocks, whose
formatted strings in order of ``block`` are the conversation.

Defined results: null text or role counts as empty; turns are ordered by
turn, role, text (nulls first), equal rows stay as often as they come; rows
with a null conversation id form one conversation; no rows give no blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.llm.columnar import ragged, slices, text_buffer

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Strings that some chat template gives a meaning.
CONTROL = (BEGIN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _pattern(marks: str) -> re.Pattern:
    """A control string's first character and backslashes; the rest of it follows."""
    return re.compile("|".join(f"{re.escape(s[0])}{marks}(?={re.escape(s[1:])})" for s in CONTROL))


PLAIN, ESCAPED = _pattern(r"\\*"), _pattern(r"\\+")
TURN = re.compile(f"{re.escape(BEGIN)}(.*?)\n(.*?){re.escape(END)}\n", re.DOTALL)


def escape(text: str) -> str:
    return PLAIN.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][:-1], text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


def _filled(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "") if column.null_count else column


def _escaped(texts: pa.Array) -> pa.Array:
    """Only texts that hold a first character of a control string go through Python."""
    maybe = pc.match_substring_regex(texts, "[<\\[]").to_numpy(zero_copy_only=False).astype(bool)
    if not maybe.any():
        return texts
    done = pa.array([escape(t) for t in texts.filter(pa.array(maybe)).to_pylist()], texts.type)
    return pc.replace_with_mask(texts, pa.array(maybe), done)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """All turns' bytes in one buffer; byte offset of each turn (turns + 1); begin and length of its text there."""
    coded = roles.dictionary_encode()
    headers = [f"{BEGIN}{escape_role(r)}\n".encode() for r in coded.dictionary.to_pylist()]
    trailer = f"{END}\n".encode()
    data, ends = text_buffer(texts)
    fixed = np.frombuffer(b"".join([*headers, trailer]), np.uint8)
    sizes = np.array([*map(len, headers), len(trailer)], np.int64)
    begins = np.cumsum(sizes) - sizes
    which = coded.indices.to_numpy().astype(np.int64)
    n = len(texts)
    start = np.empty((n, 3), np.int64)
    length = np.empty((n, 3), np.int64)
    start[:, 0], length[:, 0] = begins[which], sizes[which]
    start[:, 1], length[:, 1] = len(fixed) + ends[:-1], np.diff(ends)
    start[:, 2], length[:, 2] = begins[-1], sizes[-1]
    offset = np.append(0, np.cumsum(length))
    buffer = pa.allocate_buffer(int(offset[-1]))
    out = np.frombuffer(buffer, np.uint8)
    np.take(np.concatenate((fixed, data)), ragged(start.ravel(), length.ravel()), out=out)
    return buffer, offset[::3], np.stack((offset[1::3], length[:, 1]), 1)


BLOCK = ("block", "n_turns", "formatted", "loss_start", "loss_length")
BLOCK_TYPES = "block long, n_turns long, formatted string, loss_start array<int>, loss_length array<int>"


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Blocks of formatted conversations: id, block, n_turns, formatted, loss_start and loss_length (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for b in batches:
            role, text = _filled(b.column(1)), _escaped(_filled(b.column(2)))
            for lo, hi in slices(text):
                ids = b.column(0).slice(lo, hi - lo)
                part = role.slice(lo, hi - lo)
                buffer, offset, span = assemble(part, text.slice(lo, hi - lo))
                key = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                cuts = np.append(first, hi - lo)
                loss = np.flatnonzero(pc.equal(part, "assistant").to_numpy(zero_copy_only=False))
                here = np.searchsorted(cuts, loss, side="right") - 1
                rows = np.searchsorted(here, np.arange(len(cuts))).astype(np.int32)
                texts = pa.StringArray.from_buffers(len(first), pa.py_buffer(offset[cuts].astype(np.int32)), buffer)
                spans = [pa.ListArray.from_arrays(pa.array(rows), pa.array(x.astype(np.int32))) for x in (span[loss, 0] - offset[first[here]], span[loss, 1])]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(first)), pa.array(block + np.arange(len(first))), pa.array(np.diff(cuts)), texts, *spans], ["id", *BLOCK])
                block += len(first)

    kind = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(F.col(conv_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange("id", "turn").sortWithinPartitions("id", "turn", "role", "text")
    return dealt.select("id", "role", "text").mapInArrow(run, f"id {kind}, {BLOCK_TYPES}").withColumnRenamed("id", conv_col)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a block; raises ValueError on anything else."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a turn at {at}")
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}")
    return turns


def read_back(blocks: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted output alone: n_turns, digests of the turns and of the text under the loss mask, sizes.

    A digest is sequential by nature, so a conversation's blocks stream through one task, one block in memory at a time.
    """
    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # id, turns, digest of turns, loss characters, digest of loss, characters

        def closed(s: list) -> pa.RecordBatch:
            values = [s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True)], names)

        for b in batches:
            id_type = b.column(0).type
            for key, formatted, starts, lengths in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if state is None or state[0] != key:
                    if state is not None:
                        yield closed(state)
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                raw = formatted.encode()
                for at, size in zip(starts, lengths, strict=True):
                    text = unescape(raw[at:at + size].decode())
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
        if state is not None:
            yield closed(state)

    kind = blocks.schema[conv_col].dataType.simpleString()
    rows = blocks.select(F.col(conv_col).alias("id"), "formatted", "loss_start", "loss_length", "block").repartition("id").sortWithinPartitions("id", "block")
    out = rows.drop("block").mapInArrow(run, f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumnRenamed("id", conv_col)
