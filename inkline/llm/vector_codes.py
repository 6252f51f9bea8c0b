"""Vector codes by parts, their codebooks refined by rounds, with LAESA pivots.

A vector's components become integers ``floor(scale * x)`` and are cut into
equal consecutive parts, each coded by the nearest entry of its position's
codebook.  Distances are integers and exact, so nothing depends on the order
in which rows are summed.

For each part position a few of the starting entries, far from each other, are
the fixed pivots.  The distance of every part to its pivots is computed once
and written beside the vector.  A round computes the distances of the pivots to
the entries (a small table); by the triangle inequality the difference of the
two is a lower bound of the distance of part and entry.  A part tries its
entries in the order of that bound and stops at the first one whose bound
exceeds the best exact distance so far.  The bounds are lowered by more than
their rounding error, so an entry is passed over only if it is truly farther.

A round reads the written table, sums parts and counts per entry inside each
task, and brings one row per part position and entry to the driver, whatever
the number of vectors.

Defined results: rows whose vector is null, or holds null or non-finite
components, go; so do empty vectors and those whose length is not the most
frequent one (of equally frequent ones the longest).  Starting entries are
those of the smallest distinct ids, a null id after all others, and of rows
with the same id the smallest vector; with fewer ids there are fewer entries.
Repeated rows are coded each.  An empty table gives no rows and empty
codebooks.  A length that ``parts`` doesn't divide, and integers whose squared
distances could leave 64 bits, raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.llm.attach import attach
from inkline.llm.scratch import written

#: Fixed pivots of a part position, at most.
PIVOTS = 4
#: Rows that are worked on at once.
SLICE = 8192


class Nearest(NamedTuple):
    entry: np.ndarray
    error: np.ndarray
    evaluated: int


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def far_apart(entries: np.ndarray, count: int) -> np.ndarray:
    """Indices of ``count`` entries, each the farthest from those before; the first one is the first entry."""
    chosen = [0]
    least = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of each point to each pivot (points, pivots)."""
    return np.stack([np.sqrt(((points - p) ** 2).sum(1).astype(np.float64)) for p in pivots], 1)


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray) -> Nearest:
    """The nearest entry of each point, ties to the lower index, with its exact squared distance.

    ``to_pivots`` (points, pivots) and ``entry_pivots`` (entries, pivots) hold Euclidean distances.
    """
    n, k = len(points), len(entries)
    bound = np.zeros((n, k))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - entry_pivots[:, p]), out=bound)
    bound = np.maximum(bound * (1 - 1e-12) - 1e-6, 0) ** 2 * (1 - 1e-12)
    order = np.argsort(bound, axis=1, kind="stable")
    best, which = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    open_, evaluated = np.arange(n), 0
    for rank in range(k):
        entry = order[open_, rank]
        more = bound[open_, entry] <= best[open_]
        open_, entry = open_[more], entry[more]
        if not len(open_):
            break
        evaluated += len(open_)
        d = ((points[open_] - entries[entry]) ** 2).sum(1)
        better = (d < best[open_]) | ((d == best[open_]) & (entry < which[open_]))
        at = open_[better]
        best[at], which[at] = d[better], entry[better]
    return Nearest(which, best, evaluated)


class Coded(NamedTuple):
    """``codes``: id, label, code, error of each kept row; ``books`` (parts, entries, part length), or None without rows."""

    codes: DataFrame
    books: np.ndarray | None


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _starts(kept: DataFrame, entries: int) -> np.ndarray:
    """Vectors of the smallest distinct ids."""
    ids = [r[0] for r in kept.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()]
    some = F.col("id").isin([i for i in ids if i is not None])
    if None in ids:
        some = some | F.col("id").isNull()
    rows = kept.filter(some).groupBy("id").agg(F.min("ints").alias("ints")).orderBy(F.col("id").asc_nulls_last()).collect()
    return np.array([r["ints"] for r in rows], np.int64)


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Coded:
    """Codes of all vectors after ``rounds`` rounds of assigning parts and replacing entries by floored means."""
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).filter(finite(F.col("vector")))
    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    heads = f"id {kinds['id']}, label {kinds['label']}"
    out = f"{heads}, code string, error long"
    lengths = named.groupBy(F.size("vector").alias("n")).count().filter("n > 0").orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return Coded(vectors.sparkSession.createDataFrame([], out), None)
    dims = lengths["n"]
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    width = dims // parts
    limit = int((2**62 / dims) ** 0.5) // 2
    ints = F.transform("vector", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    kept = named.filter(F.size("vector") == dims).select("id", "label", ints.alias("ints"))
    start = _starts(kept, entries)
    books = start.reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    pivots = np.stack([b[far_apart(b, PIVOTS)] for b in books])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(2), dims)
            if len(x) and max(-int(x.min()), int(x.max())) >= limit:
                raise ValueError(f"a component is beyond {limit}, squared distances could leave 64 bits")
            d = np.concatenate([distances(x[:, p * width:(p + 1) * width], pivots[p]) for p in range(parts)], 1)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * d.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(d.ravel()))], ["id", "label", "ints", "to_pivots"])

    table = written(kept.mapInArrow(measure, f"{heads}, ints array<long>, to_pivots array<double>"), "vectors")

    def assigned(b: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For slices of a batch: the parts (rows, parts, width), their entries and squared distances (rows, parts)."""
        tables = [distances(books[p], pivots[p]) for p in range(parts)]
        x, d = b.column(b.schema.get_field_index("ints")), b.column(b.schema.get_field_index("to_pivots"))
        for lo in range(0, b.num_rows, SLICE):
            points = _matrix(x.slice(lo, SLICE), dims).reshape(-1, parts, width)
            known = _matrix(d.slice(lo, SLICE), pivots.shape[0] * pivots.shape[1]).reshape(-1, parts, pivots.shape[1])
            found = [nearest(points[:, p], known[:, p], books[p], tables[p]) for p in range(parts)]
            yield points, np.stack([f.entry for f in found], 1), np.stack([f.error for f in found], 1)

    def summed(books: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for b in batches:
                for points, entry, _ in assigned(b, books):
                    for p in range(parts):
                        np.add.at(sums[p], entry[:, p], points[:, p])
                        counts[p] += np.bincount(entry[:, p], minlength=books.shape[1])
            part, entry = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

        rows = table.select("ints", "to_pivots").mapInArrow(run, "part long, entry long, n long, sums array<long>")
        return rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)))

    for _ in range(rounds):
        now = books.copy()
        for r in summed(books).collect():  # parts * entries rows at most
            now[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
        books = now

    def code(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for _, entry, error in assigned(b, books):
                codes = [bytes(r).hex() for r in entry.astype(np.uint8)] if books.shape[1] <= 256 else ["".join(f"{e:04x}" for e in r) for r in entry]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(codes)), b.column(1).slice(at, len(codes)), pa.array(codes, pa.string()), pa.array(error.sum(1))], ["id", "label", "code", "error"])
                at += len(codes)

    return Coded(table.mapInArrow(code, out), books)


def books_digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    values = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()


def coded_vectors(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error (errors of all rows with an equal label, nulls together) and the codebooks' digest."""
    done = compress(vectors, **options)
    codes = written(done.codes, "codes")
    labels = written(codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"), F.count(F.lit(1)).alias("n")), "labels")
    return attach(codes, labels, ["label"], "n").select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(done.books)).alias("codebooks_sha256"))
