"""Quality rules: base counts, and compression bands as the verdict.

Method: a text's zstandard ratio (compressed bytes / bytes) says how
repetitive it is.  Two ratios are taken, of the whole text and of fixed
chunks of it, and each must lie in a band.  Under the band a text repeats
itself, over it it is noise.

* Bands: ratios depend on length and script, so there is a class for each half
  octave of bytes and each width of characters, for whole texts and for chunks
  apart.  A first pass over all rows that pass the base rules counts ratios
  (``BIN`` wide) in each class; its band is the median less ``BELOW`` and plus
  ``ABOVE`` spreads (median absolute deviation, scaled to a standard deviation).
  The spread is at least ``LEAST`` / sqrt(bytes), so that a class full of copies
  doesn't close its band, and grows by two standard errors, 2 / sqrt(ratios),
  as few ratios tell it badly.  A class's limits are the mean of the measured ones,
  weighted by its number of ratios, and of the broad ones ``WHOLE`` and
  ``CHUNK_BAND``, which weigh as much as ``PRIOR`` texts or ``PRIOR_CHUNKS`` chunks:
  they move smoothly from the broad to the measured ones as a class fills, and
  nothing changes at any particular size.
* Chunks of ``CHUNK`` bytes (the last one joins its neighbour if it is less
  than half as long; texts below two chunks, 4,096 bytes, are judged as a whole
  only): a text fails if more than ``BAD_SHARE`` of its chunks
  lie outside their bands; so pages that are fine as a whole but hold long
  stretches of junk go, and one odd chunk doesn't reject a long text.

Base rules: at least 50 words, and at most half of the words in a 3-word
window that occurs twice or more in the text.

Defined results: a null or empty text has 0 words and fails the base rules;
each row gives one row, equal or null ids included; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.llm.columnar import trimmed

#: What separates words: the white space of ``bytes.split``.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK = 2048
#: Bands before anything is measured: length (bytes, up to), lowest and highest ratio of the whole text; the same of a chunk.
WHOLE = ((512, 0.25, 0.95), (2048, 0.22, 0.80), (8192, 0.20, 0.70), (1 << 62, 0.18, 0.65))
CHUNK_BAND = (0.20, 0.80)
BAD_SHARE = 0.2
#: Bands of the others.
BIN = 0.001
BELOW, ABOVE = 3.5, 6.0
LEAST = 0.4
#: So many texts or chunks of a class weigh as much as the bands above.
PRIOR, PRIOR_CHUNKS = 5, 20

#: Class of a ratio: whether of a chunk, bytes a character (1 to 3), half octave of the length.
Class = tuple[bool, int, int]
Bands = Mapping[Class, tuple[float, float]]

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, whole_ratio double, bad_chunks double, base_failed boolean, kept boolean"


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, its first place included."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    many = len(numbers)
    if many == len(words):
        return 0
    if many < 1 << 21:
        key = (w[:n] * many + w[1:n + 1]) * many + w[2:]
    else:  # three numbers don't fit into 63 bits: number the pairs first
        _, key = np.unique(w[:n] * many + w[1:n + 1], return_inverse=True)
        key = key * many + w[2:]
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:n + k] |= twice
    return int(inside.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def class_of(chunk: bool, width: int, n_bytes: int) -> Class:
    return chunk, width, (n_bytes * n_bytes).bit_length() - 1


def ratios(text: str, raw: bytes, press: zstandard.ZstdCompressor) -> list[tuple[Class, float]]:
    """Class and ratio of the whole text, then of its chunks; nothing for an empty text."""
    if not raw:
        return []
    width = 1 if 10 * len(raw) < 13 * len(text) else 2 if 10 * len(raw) < 23 * len(text) else 3
    out = [(class_of(False, width, len(raw)), len(press.compress(raw)) / len(raw))]
    if len(raw) < 2 * CHUNK:
        return out
    cuts = list(range(0, len(raw), CHUNK))
    if len(raw) - cuts[-1] < CHUNK // 2:
        cuts.pop()
    parts = [raw[lo:hi] for lo, hi in zip(cuts, [*cuts[1:], len(raw)], strict=True)]
    return out + [(class_of(True, width, len(p)), len(press.compress(p)) / len(p)) for p in parts]


def broad(kind: Class) -> tuple[float, float]:
    """Limits of a class of which nothing is known."""
    chunk, _, octave = kind
    return CHUNK_BAND if chunk else next((lo, hi) for most, lo, hi in WHOLE if 2 ** (octave / 2) <= most)


def in_band(found: list[tuple[Class, float]], bands: Bands) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its chunks that lie outside their bands, and the verdict."""
    if not found:
        return 0.0, 0.0, False
    kind, whole = found[0]
    low, high = bands.get(kind) or broad(kind)
    outside = 0
    for k, x in found[1:]:
        lo, hi = bands.get(k) or broad(k)
        outside += not lo <= x <= hi
    bad = outside / max(1, len(found) - 1)
    return whole, bad, low <= whole <= high and bad <= BAD_SHARE


def base_fails(n_words: int, n_repeated: int) -> bool:
    return n_words < 50 or 100 * n_repeated > 50 * n_words


def judge(text: str | None, press: zstandard.ZstdCompressor, bands: Bands = {}) -> tuple:  # noqa: B006
    """All columns of SCHEMA for one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    chars = len(text) - sum(map(text.count, BLANKS))
    repeated = repeated_window_words(words)
    whole, bad, good = in_band(ratios(text, raw, press), bands)
    base_failed = base_fails(len(words), repeated)
    return (len(words), chars, sum(map(raw.count, SYMBOLS)), duplicate_lines(raw), repeated, whole, bad, base_failed, not base_failed and good)


def middle(at: np.ndarray, n: np.ndarray) -> float:
    """Median of values ``at`` that occur ``n`` times."""
    order = np.argsort(at, kind="stable")
    total = np.cumsum(n[order])
    return float(at[order][np.searchsorted(total, total[-1] / 2)])


def band(kind: Class, at: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    centre = middle(at, n)
    spread = max(1.4826 * middle(abs(at - centre), n), LEAST / 2 ** (kind[2] / 4)) * (1 + 2 / n.sum() ** 0.5)
    share = n.sum() / (n.sum() + (PRIOR_CHUNKS if kind[0] else PRIOR))
    low, high = broad(kind)
    return float(share * (centre - BELOW * spread) + (1 - share) * low), float(share * (centre + ABOVE * spread) + (1 - share) * high)


def measure(docs: DataFrame, text_col: str = "text") -> Bands:
    """The bands of all classes that occur.  What is shuffled and collected is a count for each class and bin, whatever the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, seen = zstandard.ZstdCompressor(level=LEVEL), Counter()
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                raw = text.encode()
                words = raw.split()
                if not base_fails(len(words), repeated_window_words(words)):
                    seen.update((*kind, round(x / BIN)) for kind, x in ratios(text, raw, press))
        rows = [(*k, n) for k, n in seen.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = [pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "width", "octave", "bin", "n"])

    counts = docs.select(F.col(text_col)).mapInArrow(trimmed(run), "chunk boolean, width int, octave int, bin int, n long").groupBy("chunk", "width", "octave", "bin").agg(F.sum("n").alias("n"))
    by: dict[Class, list[tuple[int, int]]] = {}
    for r in counts.collect():
        by.setdefault((r.chunk, r.width, r.octave), []).append((r.bin, r.n))
    return {k: band(k, *(np.array(v).T * [[BIN], [1]])) for k, v in by.items()}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and the columns of SCHEMA.  Two scans, one to measure the bands; no row is shuffled."""
    bands = measure(docs, text_col)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [{"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[c.split()[1]] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            rows = [judge(t.as_py(), press, bands) for t in b.column(1)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(trimmed(run), f"id {kind}, {SCHEMA}")
    return out.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns."""
    bands = measure(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            yield b.filter(pa.array([judge(t.as_py(), press, bands)[-1] for t in b.column(at)], pa.bool_()))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(trimmed(run), docs.schema)
