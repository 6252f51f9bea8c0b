"""Language identification by error-correcting output codes.

Each language has a codeword of +1 / -1.  One binary linear classifier per
bit, over hashed byte n-grams (1 to 3 bytes, lower case, everything but
letters as a blank), predicts the bits.  Decoding is loss-weighted: a
language's distance is the sum over bits of the logistic loss of the margin
against its codeword, each bit weighted by how well its classifier did on that
language in training.  The nearest codeword wins; a text is flagged ambiguous
when the runner-up is nearly as near.

Training uses at most ``SAMPLE`` texts of each language, ``SAMPLE_ALL`` in
all but one of each language at least (those whose id hash is smallest, so the
same ones in every run; an id counts once however often it comes); scoring reads
every whole text.

Defined results: ``und`` and score 0 for null texts, texts without a letter,
or when no language could be learned; a null id is never held out nor
trained on; each row gives one row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.llm.columnar import slices, text_buffer
from inkline.llm.pretokens import LETTER, code_points, unicode_classes
from inkline.llm.scratch import written

#: Texts that train, at most: of each language, and of all (each language gets an equal share).
SAMPLE = 1000
SAMPLE_ALL = 8000
#: Bits of the id hash that one round of the selection settles.
ROUND_BITS = 12
BITS = 16
EPOCHS = 3
RATE = 1.0
#: The runner-up's score must be this much lower.
MARGIN = 0.2
GRAMS = (1, 2, 3)
#: Scoring holds a row of weights per byte, so its slices are small.
SLICE = 1 << 19


class Model(NamedTuple):
    langs: list[str]
    codes: np.ndarray  # languages x bits, +1 / -1
    trust: np.ndarray  # languages x bits, rows sum to 1
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray


def codewords(n: int) -> np.ndarray:
    """n codewords far apart: all 2^(n-1) - 1 ways to split few languages in two, else the best of random codes."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 5:
        columns = [[1] + [1 if c >> (n - 2 - i) & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, float).T
    rng = np.random.default_rng(n)
    size = max(15, int(np.ceil(10 * np.log2(n))))
    best, far = None, -1
    for _ in range(200):
        codes = rng.choice([-1.0, 1.0], (n, size))
        apart = min(int((codes[i] != codes[i + 1:]).sum(1).min()) for i in range(n - 1))
        if apart > far and (abs(codes.sum(0)) < n).all():
            best, far = codes, apart
    return best


def buckets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each n-gram length the bucket of the gram that starts at each byte (0: none); row offsets; whether each row has a letter."""
    data, ends = text_buffer(pc.utf8_lower(texts))
    pos, cp = code_points(data)
    letter = unicode_classes()[cp] == LETTER if len(cp) else np.zeros(0, bool)
    has = np.diff(np.append(0, np.cumsum(letter))[np.searchsorted(pos, ends)]) > 0
    byte_letter = np.repeat(letter, np.diff(np.append(pos, len(data)))) if len(pos) else letter
    b = np.where(byte_letter, data, np.uint8(0x20)).astype(np.uint32)
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(b))  # bytes from here to the end of the row
    out, code = [], np.zeros(len(b), np.uint32)
    blank = np.ones(len(b), bool)
    for n in range(1, max(GRAMS) + 1):
        code[:len(b) - n + 1] = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
        blank[:len(b) - n + 1] &= b[n - 1:] == 0x20
        if n in GRAMS:
            with np.errstate(over="ignore"):
                mixed = ((code + np.uint32(n)) * np.uint32(2654435769)) >> np.uint32(32 - BITS)
            mixed[blank | (left < n)] = 0
            out.append(mixed)
    return out, ends, has


def scale(counts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Factor of a text's gram counts: relative frequencies, times the root of the number of different grams."""
    return np.sqrt(kinds) / np.maximum(1, counts)


def learn(sample: pd.DataFrame) -> Model | None:
    """Bit classifiers by logistic regression (AdaGrad) over the sample's texts, in its order."""
    langs = sorted(sample["lang"].unique())
    if not langs:
        return None
    codes = codewords(len(langs))
    target = codes[[langs.index(x) for x in sample["lang"]]]
    rows = []
    texts = pa.array(sample["text"], pa.string())
    for lo, hi in slices(texts, SLICE):
        grams, ends, _ = buckets(texts.slice(lo, hi - lo))
        for a, z in zip(ends[:-1], ends[1:], strict=True):
            at, n = np.unique(np.concatenate([g[a:z] for g in grams]), return_counts=True)
            at, n = at[at > 0], n[at > 0]
            rows.append((at.astype(np.int32), (n * scale(n.sum(), len(at))).astype(np.float32)))
    weights, seen = np.zeros((1 << BITS, codes.shape[1])), np.full((1 << BITS, codes.shape[1]), 1e-3)
    bias = np.zeros(codes.shape[1])
    for _ in range(EPOCHS):
        for (at, x), t in zip(rows, target, strict=True):
            margin = x @ weights[at] + bias
            slope = -t / (1 + np.exp(np.clip(t * margin, -30, 30)))
            step = x[:, None] * slope
            seen[at] += step * step
            weights[at] -= RATE * step / np.sqrt(seen[at])
            bias -= 0.01 * slope
    right = np.zeros_like(codes)
    for (at, x), t, lang in zip(rows, target, sample["lang"], strict=True):
        right[langs.index(lang)] += (x @ weights[at] + bias) * t > 0
    trust = np.maximum(right, 1e-6)
    return Model(langs, codes, trust / trust.sum(1, keepdims=True), weights.astype(np.float32), bias)


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    lang, score, unsure = [], [], []
    for lo, hi in slices(texts, SLICE):
        grams, ends, has = buckets(texts.slice(lo, hi - lo))
        rows = np.flatnonzero(np.diff(ends) > 0)
        total = np.zeros((hi - lo, model.weights.shape[1]))
        n, kinds = np.zeros(hi - lo), np.zeros(hi - lo)
        if len(rows):
            begin = ends[:-1][rows]
            for g in grams:
                total[rows] += np.add.reduceat(model.weights[g], begin, axis=0, dtype=np.float64) - np.add.reduceat(g == 0, begin, dtype=np.int64)[:, None] * model.weights[0]
                n[rows] += np.add.reduceat(g > 0, begin, dtype=np.int64)
            for i, (a, z) in zip(rows, zip(ends[:-1][rows], ends[1:][rows], strict=True), strict=True):
                mark = np.zeros(1 << BITS, bool)
                for g in grams:
                    mark[g[a:z]] = True
                kinds[i] = np.count_nonzero(mark[1:])
        margin = total * scale(n, kinds)[:, None] + model.bias
        loss = np.logaddexp(0, -margin[:, None, :] * model.codes[None]) * model.trust[None]
        far = loss.sum(2) * model.codes.shape[1]
        p = np.exp(far.min(1, keepdims=True) - far)
        p /= p.sum(1, keepdims=True)
        best = far.argmin(1)
        two = np.sort(p, 1)
        gap = two[:, -1] - (two[:, -2] if p.shape[1] > 1 else 0)
        lang += [model.langs[k] if ok else "und" for k, ok in zip(best, has, strict=True)]
        score.append(np.where(has, p[np.arange(len(best)), best], 0.0))
        unsure.append(~has | (gap < MARGIN))
    return lang, np.concatenate([np.zeros(0), *score]), np.concatenate([np.zeros(0, bool), *unsure])


def cut_offs(keys: DataFrame, most: int) -> dict[str, int]:
    """For each ``lang`` the ``most``-th smallest of its distinct ``at``, or a bound above all of them where it has fewer.

    Radix selection: a round counts keys by language and the next ``ROUND_BITS`` bits of the hash, map-side first, and narrows each language to the one bin in which its cut-off lies.  What a round shuffles and collects is a count for each language and bin; no language's rows are gathered anywhere.
    """
    place = F.col("at").bitwiseXOR(F.lit(-1 << 63))  # as unsigned bits, these are in the order of the signed hash
    open_: dict[str, tuple[int, int]] = {r["lang"]: (0, most) for r in keys.select("lang").distinct().collect()}  # settled bits, keys still to take
    done: dict[str, int] = {}
    left = 64
    while open_ and left:
        step = min(ROUND_BITS, left)
        inside = F.lit(left == 64)
        if left < 64:
            for lang, (prefix, _) in open_.items():
                inside = inside | ((F.col("lang") == lang) & (F.shiftrightunsigned(place, left) == prefix))
        left -= step
        digit = F.shiftrightunsigned(place, left).bitwiseAND(F.lit((1 << step) - 1))
        counts: dict[str, list[tuple[int, int]]] = {}
        for r in keys.filter(inside).groupBy("lang", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["lang"], []).append((r["digit"], r["n"]))
        for lang, (prefix, need) in list(open_.items()):
            for bin_, n in sorted(counts.get(lang, [])):
                if need <= n:
                    break
                need -= n
            else:  # fewer keys than asked for: all of them
                bin_, n = (1 << step) - 1, need
            prefix = prefix << step | bin_
            if need == n:  # the whole bin is taken
                done[lang] = ((prefix + 1 << left) - 1) - (1 << 63)
                del open_[lang]
            else:
                open_[lang] = prefix, need
    return done


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model from the rows that ``usable`` marks.

    Rows with one language and id count once, with their smallest text.  Each language's sample is bounded by a cut-off on the id hash, found by counting distinct (language, hash) pairs.
    """
    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("at"))
    keys = written(rows.select("lang", "at").distinct(), "keys")
    n_langs = keys.select("lang").distinct().count()
    if not n_langs:
        return None
    limits = cut_offs(keys, max(1, min(SAMPLE, SAMPLE_ALL // n_langs)))  # a number per language
    chosen = F.lit(False)
    for lang, last in limits.items():
        chosen = chosen | ((F.col("lang") == lang) & (F.col("at") <= last))
    sample = rows.filter(chosen).groupBy("lang", "at").agg(F.min("text").alias("text")).toPandas()  # SAMPLE_ALL texts at most, or one a language
    return learn(sample.sort_values(["at", "lang"]).reset_index(drop=True))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, ambiguous."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None:
                lang, score, unsure = ["und"] * len(b), np.zeros(len(b)), np.ones(len(b), bool)
            else:
                lang, score, unsure = predict(model, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)], ["id", "lang_pred", "score", "ambiguous"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)
