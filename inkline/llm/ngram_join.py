"""Near-duplicate join: Jaccard similarity of word 5-gram sets, by a MinHash LSH forest.

1. One scan computes each text's shingle set, a key of the set and its paths
   through ``TREES`` tries of MinHash steps.  A path is one sortable integer,
   so a prefix is a right shift.
2. Texts with equal sets form a class, found by an aggregation with map-side
   combining; copies go no further than this.
3. In each trie, classes meet in a bucket that share a prefix.  The prefix
   starts at ``LONG`` steps and is shortened as long as the target recall
   asks for it: a pair of similarity s shares d steps of one of T tries with
   probability 1 - (1 - s^d)^T, and ``depth_for`` takes the deepest d that
   reaches the target.  Where the shorter prefix holds few classes it is
   shortened on, to ``SHORT`` steps; that only adds recall, and crowded places
   (a passage that very many texts share) keep the long prefix.
4. Classes that buckets connect form a neighbourhood, found over one edge for
   each class and bucket (to the bucket's smallest class), never over pairs.
   A neighbourhood is dealt into blocks of ``BLOCK`` classes, and each two
   blocks meet in a cell: a class's shingles travel to its cells only, a cell
   holds two blocks at most, and no class is dropped.
5. A cell compares the pairs that share a bucket, exactly, and returns a count
   of links for each class and a spanning forest of its links, so rows grow
   with the classes and not with the pairs of a crowd.  Each pair belongs to
   one cell, so counts add up.  ``links`` lists the pairs where a caller wants
   them.

Recall at similarity 0.8 with 40 tries is 0.99992 for 7 steps and above
0.9999999 for 5; above 0.8 it is higher.  What is returned is exact: every
link was verified.

Defined results: a text without words (null counts as empty) has an empty set
and no links, and shares its class only with equal texts; texts of one to four
words have one shingle; rows with equal id and equal text are one document,
repeated; null ids order after all others; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkline.llm.attach import attach
from inkline.llm.columnar import slices, trimmed
from inkline.llm.components import components
from inkline.llm.scratch import written
from inkline.llm.shingles import LONG, SHORT, STEP_BITS, TREES, shingle_sets, trie_keys

SIMILARITY = 0.8
RECALL = 0.9999
#: A prefix with at most so many classes is short enough.
FEW = 64
#: Classes of a block; a cell holds two of them.
BLOCK = 128
#: Entries of a cell's incidence matrix; beyond, its pairs are compared one by one.
MATRIX = 8 << 20
#: Bytes of text whose shingles are held at once.
SLICE = 2 << 20

KEYS = "doc_key binary, text_key binary, set_key binary, n_shingles int, paths array<long>"


def depth_for(similarity: float, recall: float) -> int:
    """Deepest prefix whose expected recall at the similarity reaches the target."""
    reach = [d for d in range(SHORT, LONG + 1) if 1 - (1 - similarity ** d) ** TREES >= recall]
    if not reach:
        raise ValueError(f"{TREES} tries don't reach a recall of {recall} at {similarity}")
    return max(reach)


def document_keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Keys of (id, text) and of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), text))), F.unhex(F.md5(text))


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, keys, number of shingles and paths of each row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(3)
            for lo, hi in slices(texts, SLICE):
                sets = shingle_sets(texts.slice(lo, hi - lo))
                some = np.diff(sets.rows) > 0
                count, keys = np.zeros(hi - lo, np.int32), b.column(2).slice(lo, hi - lo).to_pylist()
                for i in np.flatnonzero(some):
                    own = np.unique(sets.hashes[sets.rows[i]:sets.rows[i + 1]])
                    count[i], keys[i] = len(own), xxhash.xxh3_128_digest(own.tobytes())
                paths = trie_keys(sets).view(np.int64)
                ends = np.append(0, np.cumsum(some * TREES)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(lo, hi - lo) for k in range(3)), pa.array(keys, pa.binary()), pa.array(count), pa.ListArray.from_arrays(pa.array(ends), pa.array(paths.ravel()))], ["id", "doc_key", "text_key", "set_key", "n_shingles", "paths"])

    doc_key, text_key = document_keys(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), doc_key.alias("doc_key"), text_key.alias("text_key"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(trimmed(run), f"id {kind}, {KEYS}"), "sketch")


def classes(rows: DataFrame) -> DataFrame:
    """Classes of equal shingle sets: number c, set_key, n_shingles, paths, n_texts, and a document that stands for it."""
    texts = rows.groupBy("set_key", "text_key").agg(F.min(F.struct(F.col("id").isNull(), "id", "doc_key")).alias("first"), F.max("n_shingles").alias("n_shingles"), F.max("paths").alias("paths"))
    sets = texts.groupBy("set_key").agg(F.min("first").alias("first"), F.max("n_shingles").alias("n_shingles"), F.max("paths").alias("paths"), F.count(F.lit(1)).alias("n_texts"))
    return written(sets.select(F.monotonically_increasing_id().alias("c"), "set_key", "n_shingles", "paths", "n_texts", F.col("first.id").alias("id"), F.col("first.doc_key").alias("doc_key")), "classes")


def buckets(found: DataFrame, similarity: float, recall: float) -> DataFrame:
    """c, bucket, leader (the bucket's smallest class) of every bucket with two classes or more."""
    shift = lambda steps: F.shiftrightunsigned("path", STEP_BITS * (LONG - steps))
    deep = depth_for(similarity, recall)
    prefixes = [f"p{d}" for d in range(SHORT, deep + 1)]
    entry = found.select("c", F.posexplode("paths").alias("tree", "path"))
    entry = entry.select("c", "tree", *(shift(d).alias(f"p{d}") for d in range(SHORT, deep + 1)))
    for k, p in enumerate(prefixes):  # windows on longer prefixes reuse the exchange on (tree, shortest prefix)
        entry = entry.withColumn(f"n_{p}", F.count(F.lit(1)).over(Window.partitionBy("tree", *prefixes[:k + 1])))
        if k == 0:
            entry = entry.filter(f"n_{p} > 1")
    level, size = F.lit(len(prefixes) - 1), F.col(f"n_{prefixes[-1]}")
    for k in reversed(range(len(prefixes) - 1)):
        fits = F.col(f"n_{prefixes[k]}") <= FEW
        level, size = F.when(fits, F.lit(k)).otherwise(level), F.when(fits, F.col(f"n_{prefixes[k]}")).otherwise(size)
    met = entry.withColumn("level", level).withColumn("size", size).filter("size > 1")
    met = met.withColumn("prefix", F.element_at(F.array(*prefixes), F.col("level") + 1))
    leader = F.min("c").over(Window.partitionBy("tree", prefixes[0], "level", "prefix"))
    return written(met.select("c", F.xxhash64("tree", "level", "prefix").alias("bucket"), leader.alias("leader")), "buckets")


def neighbourhoods(met: DataFrame) -> DataFrame:
    """Per class: its buckets, its neighbourhood, block and number of blocks."""
    near = written(components(met.filter("c <> leader").select(F.col("c").alias("u"), F.col("leader").alias("v")).distinct()), "near")
    parts = written(near.groupBy("root").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "parts")
    placed = attach(near, parts, ["root"], "n").withColumnRenamed("node", "c").withColumn("block", F.pmod(F.hash("c"), F.col("blocks")))
    return met.groupBy("c").agg(F.collect_list("bucket").alias("buckets")).join(placed, "c")


def linked_pairs(own: list[np.ndarray], shared: list[np.ndarray], block: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i, j of a cell's classes that share a bucket and are similar, and their similarity.

    If the classes are of two blocks, pairs are of one class of each; a block's own pairs have a cell of their own.
    """
    n = np.array([len(x) for x in own])
    owner = np.repeat(np.arange(len(own)), [len(x) for x in shared])
    order = np.argsort(np.concatenate(shared), kind="stable")
    values, owner = np.concatenate(shared)[order], owner[order]
    ask = np.zeros((len(own), len(own)), bool)
    cuts = np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])), len(values))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi - lo > 1:
            ask[np.ix_(owner[lo:hi], owner[lo:hi])] = True
    ask &= np.minimum.outer(n, n) >= np.maximum.outer(n, n) * similarity - 1e-9
    ask &= (block[:, None] < block[None]) if block.min() < block.max() else np.triu(np.ones_like(ask), 1)
    i, j = np.nonzero(ask)
    if not len(i):
        return i, j, np.zeros(0)
    names, place = np.unique(np.concatenate(own), return_inverse=True)
    if len(names) * len(own) <= MATRIX and len(i) > len(own):
        has = np.zeros((len(own), len(names)), np.float32)
        has[np.repeat(np.arange(len(own)), n), place] = 1
        both = (has @ has.T)[i, j].astype(np.int64)
    else:
        both = np.array([len(np.intersect1d(own[a], own[b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    jaccard = both / (n[i] + n[j] - both)
    good = jaccard >= similarity - 1e-12
    return i[good], j[good], jaccard[good]


def forest(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all of them connect."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = top(a), top(b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


def cells(docs: DataFrame, found: DataFrame, around: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each class and cell: the class's shingles and buckets, sorted by cell within partitions."""
    wanted = found.select("c", "doc_key", "n_texts").join(around, "c")
    texts = docs.select(document_keys(id_col, text_col)[0].alias("doc_key"), F.col(text_col).alias("text"))
    rows = texts.join(wanted, "doc_key").select("root", "block", "blocks", "c", "n_texts", "buckets", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(6), SLICE):
                s = shingle_sets(b.column(6).slice(lo, hi - lo))
                own = [np.unique(s.hashes[x:z]).view(np.int64) for x, z in zip(s.rows[:-1], s.rows[1:], strict=True)]
                ends = np.append(0, np.cumsum([len(x) for x in own])).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(lo, hi - lo) for k in range(6)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own)))], ["root", "block", "blocks", "c", "n_texts", "buckets", "own"])

    shipped = rows.mapInArrow(trimmed(sets), "root long, block int, blocks int, c long, n_texts long, buckets array<long>, own array<long>")
    shipped = shipped.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    shipped = shipped.select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "c", "n_texts", "buckets", "own")
    return shipped.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "c")


def compared(dealt: DataFrame, similarity: float, pairs: bool) -> DataFrame:
    """Of each cell: its links (a, b, jaccard), or per class the number of texts linked (a, NULL, number) and a spanning forest (a, b, NULL)."""

    def result(held: list) -> list[tuple]:
        if len(held) < 2:
            return []
        c = np.array([x[0] for x in held])
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))  # rows of one id and text come more than once
        held, c = [held[k] for k in first], c[first]
        i, j, jaccard = linked_pairs([x[4] for x in held], [x[3] for x in held], np.array([x[1] for x in held]), similarity)
        if pairs:
            return list(zip(np.minimum(c[i], c[j]).tolist(), np.maximum(c[i], c[j]).tolist(), jaccard.tolist(), strict=True))
        texts = np.array([x[2] for x in held])
        n = np.bincount(i, texts[j], len(held)) + np.bincount(j, texts[i], len(held))
        return [(int(c[k]), None, n[k]) for k in np.flatnonzero(n)] + [(int(c[a]), int(c[b]), None) for a, b in forest(i, j)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["a", "b", "value"])

        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
            block, c, texts = (b.column(k).to_pylist() for k in range(3, 6))
            out = []
            for k, key in enumerate(keys):
                if key != at:
                    out += result(held)
                    at, held = key, []
                # copies: the batch's own memory needn't stay
                held.append((c[k], block[k], texts[k], b.column(6)[k].values.to_numpy().copy(), b.column(7)[k].values.to_numpy().copy()))
            yield batch(out)
        yield batch(result(held))

    return dealt.mapInArrow(trimmed(run), "a long, b long, value double")


class Join(NamedTuple):
    """``rows``: doc id, doc_key, set_key of each document; ``classes``: c, set_key, id (of its first document), n_texts, ...; ``cells``: what ``compared`` reads."""

    rows: DataFrame
    classes: DataFrame
    cells: DataFrame
    similarity: float


def jaccard_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> Join:
    rows = sketch(docs, id_col, text_col)
    found = classes(rows)
    around = neighbourhoods(buckets(found.filter("n_shingles > 0"), similarity, recall))
    return Join(rows, found, cells(docs, found, around, id_col, text_col), similarity)


def links(join: Join) -> DataFrame:
    """Every link a < b between classes, with its Jaccard similarity.  Their number may grow with the square of a crowd."""
    return compared(join.cells, join.similarity, True).withColumnRenamed("value", "jaccard")


def groups(join: Join) -> DataFrame:
    """Per class: set_key, copy_id, class_id (smallest id of all that links connect), keep (document key of that one), n_links."""
    out = written(compared(join.cells, join.similarity, False), "links")
    n = out.filter("b IS NULL").groupBy(F.col("a").alias("c")).agg(F.sum("value").cast("long").alias("linked"))
    near = components(out.filter("b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("v")))
    every = join.classes.join(near.withColumnRenamed("node", "c"), "c", "left").join(n, "c", "left")
    every = written(every.select("set_key", "id", "n_texts", "doc_key", F.coalesce("root", "c").alias("root"), F.coalesce("linked", F.lit(0)).alias("linked")), "every")
    first = written(every.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "doc_key")).alias("first"), F.count(F.lit(1)).alias("n")), "first")
    return attach(every, first, ["root"], "n").select("set_key", F.col("id").alias("copy_id"), F.col("first.id").alias("class_id"), F.col("first.doc_key").alias("keep"), (F.col("linked") + F.col("n_texts") - 1).alias("n_links"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id (smallest id of the documents that links connect with it), copy_id (smallest id with the same shingles), n_links (different texts it is linked to)."""
    join = jaccard_join(docs, similarity, id_col=id_col, text_col=text_col)
    out = join.rows.select("id", "set_key").join(groups(join), "set_key")
    return out.select(F.col("id").alias(id_col), "class_id", "copy_id", "n_links")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each class (its smallest id), with all their columns."""
    join = jaccard_join(docs, similarity, id_col=id_col, text_col=text_col)
    gone = join.rows.select("doc_key", "set_key").join(groups(join).select("set_key", "keep"), "set_key").filter("doc_key <> keep").select("doc_key").distinct()
    own = docs.columns
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("doc"), document_keys(id_col, text_col)[0].alias("doc_key"))
    place = F.row_number().over(Window.partitionBy("doc_key").orderBy("doc_key"))
    left = keyed.join(gone, "doc_key", "left_anti").withColumn("place", place).filter("place = 1")
    return left.select(*(F.col("doc").getField(c).alias(c) for c in own))
