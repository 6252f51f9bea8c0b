"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

A text is cut into words, marks and line ends.  Its features are hashed
n-grams of three kinds, each kind a relative frequency over the text:

* words and pairs of words;
* shapes of words (case, digits, which mark), one to three in a row;
* back-references: the same word 1 to 4 places before, and a pair of words
  that the text had already.

Weights are learned by follow-the-regularised-leader updates (FTRL-proximal:
per-coordinate rates, L1 and L2), so most stay 0; a score is the sigmoid of a
sparse dot product.

Training uses at most ``SAMPLE`` labelled texts (those whose id hash is
smallest, so the same ones in every run); scoring reads every whole text.

Defined results: a null or empty text has no features and scores the bias
alone; without any labelled row every score is 0.5; labels of one document
that disagree count once, as the larger; of several texts under one id the
first in order trains; each row gives one row; a null id is neither held out
nor trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.llm import pretokens
from inkline.llm.columnar import slices, text_buffer

#: Labelled texts that train, at most.
SAMPLE = 6000
BITS = 18
#: FTRL-proximal: rate, smoothing of the rate, L1, L2.
ALPHA, BETA, L1, L2 = 0.3, 0.1, 1e-4, 1e-3
#: Updates to make in all; each text is used 4 times at least and 40 times at most.
UPDATES = 24_000
#: Rows of features are held for a slice, so slices are small.
SLICE = 1 << 20
#: Predicted 1 from this score on.
THRESHOLD = 0.3

MIX = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * MIX
        return h ^ (h >> np.uint64(32))


def _next(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(h * np.uint64(31) + more)


#: Features of no word: of a place without a back-reference, and of each kind of back-reference.
MARKS = _mixed(np.arange(1, 7, dtype=np.uint64) << np.uint64(50))


def word_table(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Hash (without a blank in front) and shape of each distinct pre-token; shape 0 is white space without a line end."""
    data, ends = text_buffer(words)
    size = np.diff(ends)
    begin = ends[:-1] + ((data[ends[:-1]] == 0x20) & (size > 1))
    size = ends[1:] - begin
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    b = data[np.repeat(begin, size) + at]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(size.max()) + 1, 0x100000001B3, np.uint64))
        h = _mixed(np.add.reduceat((b.astype(np.uint64) + np.uint64(1)) * power[at], np.cumsum(size) - size))
    count = lambda test: np.bincount(row, test, len(size))
    upper, lower = count((b >= 65) & (b <= 90)), count((b >= 97) & (b <= 122) | (b >= 0x80))
    digit, line = count((b >= 48) & (b <= 57)), count(b == 10)
    first = data[begin]
    blank = count((b == 32) | (b >= 9) & (b <= 13)) == size
    letters = upper + lower > 0
    shape = np.where(letters, 1 + (upper > 0) + 2 * (upper > 1) + 4 * (lower == 0) * (upper > 1), 0)
    shape = np.where(~letters & (digit > 0), 16 + np.minimum(digit, 15), shape)
    shape = np.where(~letters & (digit == 0) & ~blank, 32 + first.astype(np.int64) * 4 + np.minimum(size, 4) - 1, shape)
    shape = np.where(blank, np.where(line > 0, 12 + np.minimum(line, 3), 0), shape)
    return h, shape.astype(np.int64)


def features(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each kind: the buckets of its n-grams in order of the text, and the index of each row's first one (rows + 1)."""
    data, ends = text_buffer(texts)
    cut = pretokens.split(data, ends)
    if len(cut.starts) == 1:
        return [np.zeros(0, np.int64)] * 3, [np.zeros(len(ends), np.int64)] * 3
    which, words = pretokens.distinct(data, cut.starts)
    h, shape = word_table(words)
    kept = np.flatnonzero(shape[which] > 0)
    rows = np.searchsorted(kept, cut.rows)
    h, shape = h[which[kept]], shape[which[kept]]
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    same = lambda k: row[k:] == row[:-k]
    bucket = lambda x: (x >> np.uint64(64 - BITS)).astype(np.int64)

    pair = np.zeros(len(h), np.uint64)
    pair[1:] = _next(h[:-1], h[1:])
    has2, has3 = np.zeros(len(h), bool), np.zeros(len(h), bool)
    has2[1:], has3[2:] = same(1), same(2)
    s1 = _mixed(shape.astype(np.uint64) + np.uint64(1 << 40))
    s2, s3 = s1.copy(), s1.copy()
    s2[1:] = _next(s1[:-1], s1[1:])
    s3[2:] = _next(s2[1:-1], s1[2:])
    back = []
    for k in range(1, 5):
        hit = np.zeros(len(h), bool)
        hit[k:] = (h[k:] == h[:-k]) & same(k)
        back.append(hit)
    again = np.zeros(len(h), bool)  # this pair of words stood in the text before
    order = np.lexsort((pair, row))
    again[order[1:]] = (pair[order[1:]] == pair[order[:-1]]) & (row[order[1:]] == row[order[:-1]]) & has2[order[1:]] & has2[order[:-1]]
    def kind(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return bucket(np.stack(parts, 1).ravel()), rows * len(parts)

    found = [kind([h, np.where(has2, pair, h)]), kind([s1, np.where(has2, s2, s1), np.where(has3, s3, s1)]), kind([np.where(hit, MARKS[k], MARKS[0]) for k, hit in enumerate([*back, again], 1)])]
    return [f for f, _ in found], [r for _, r in found]


def sparse(found: list[np.ndarray], rows: list[np.ndarray], i: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one row and their values."""
    at, x = [], []
    for f, r in zip(found, rows, strict=True):
        part = f[r[i]:r[i + 1]]
        at.append(part)
        x.append(np.full(len(part), 1 / max(1, len(part))))
    at, x = np.concatenate(at), np.concatenate(x)
    keys, place = np.unique(at, return_inverse=True)
    return keys, np.bincount(place, x, len(keys))


def learn(sample: pd.DataFrame) -> Model:
    """FTRL over the sample's texts, in its order."""
    docs = []
    texts = pa.array(sample["text"], pa.string())
    for lo, hi in slices(texts, SLICE):
        found, rows = features(texts.slice(lo, hi - lo))
        docs += [tuple(a.astype(t) for a, t in zip(sparse(found, rows, i), (np.int32, np.float32), strict=True)) for i in range(hi - lo)]
    size = (1 << BITS) + 1  # the bias comes last
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(min(40, max(4, UPDATES // max(1, len(docs))))):
        for (at, x), y in zip(docs, sample["quality"], strict=True):
            at, x = np.append(at, size - 1), np.append(x, 1.0)
            g = (1 / (1 + np.exp(-np.clip(x @ w[at], -30, 30))) - y) * x
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w[at]
            w[at] = np.where(abs(z[at]) > L1, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def predict(model: Model, texts: pa.Array) -> np.ndarray:
    """Score of each text: the sigmoid of bias + sum of the kinds' mean weights."""
    out = [np.zeros(0)]
    for lo, hi in slices(texts, SLICE):
        found, rows = features(texts.slice(lo, hi - lo))
        total = np.full(hi - lo, model.bias)
        for f, r in zip(found, rows, strict=True):
            sums = np.append(0.0, np.cumsum(model.weights[f], dtype=np.float64))
            total += (sums[r[1:]] - sums[r[:-1]]) / np.maximum(1, np.diff(r))
        out.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
    return np.concatenate(out)


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Model from the labelled documents that ``usable`` (of the id) marks.

    The sample's bound is found on the labels alone; at most SAMPLE labels are then joined to the documents.
    """
    known = labels.filter(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("quality"))
    chosen = known.withColumn("at", F.xxhash64("id")).orderBy("at", "id").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"), F.min("at").alias("at")).toPandas()
    if not len(sample):
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    return learn(sample.fillna({"text": ""}).sort_values(["at", "id"]).reset_index(drop=True))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = predict(model, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
