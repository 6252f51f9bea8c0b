"""Vector codes against a plain recomputation in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from inkline.llm import vector_codes as V

COLUMNS = "vec_id long, embedding array<float>, label int, id int, code string, n long"


def plain(rows, parts=8, k=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    by_id = {}
    for i, v, _ in kept:
        by_id[i] = min(v, by_id.get(i, v))
    ids = sorted(by_id, key=lambda i: (i is None, i or 0))[:k]
    w = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * w:(p + 1) * w]) for p in range(parts)]
    books = [[cut(by_id[i])[p] for i in ids] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v)[p], books[p])[1], []).append(cut(v)[p])
            books[p] = [tuple(sum(c) // len(c) for c in zip(*groups[j], strict=True)) if j in groups else e for j, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, lab in kept:
        found = [near(x, books[p]) for p, x in enumerate(cut(v))]
        error = sum(d for d, _ in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{j:02x}" for _, j in found), error, lab))
    return sorted(((i, c, e, by_label[lab], digest) for i, c, e, lab in out), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, lab, 1, "x", 2) for i, v, lab in rows], COLUMNS)
    return sorted((tuple(r) for r in V.coded_vectors(df).collect()), key=str)


def f32(values):
    return [float(np.float32(x)) for x in values]


def test_codes_equal_plain(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = [(int(i), f32(centres[i % 6] + rng.normal(size=16) * 0.2), int(i % 4) if i % 11 else None) for i in rng.permutation(300) + 50]
    rows += [(400, None, 1), (1, [None] + [0.5] * 15, 1), (2, [math.nan] + [0.5] * 15, 1), (3, [math.inf] * 16, 2), (4, [], 2)]
    rows += [rows[0]] * 40 + [(None, f32(rng.normal(size=16)), 3), (60, [0.0] * 16, 0), (61, [-0.0001] * 16, 0)]
    assert run(spark, rows) == plain(rows)


def test_few_rows_ties_and_grid(spark):
    grid = [(i, [float(i % 3), float(i % 2)] * 8, None) for i in range(40)]  # many equal entries and equal distances
    assert run(spark, grid) == plain(grid)
    assert run(spark, grid[:3]) == plain(grid[:3])
    assert run(spark, [(None, [1.0] * 16, 1)]) == plain([(None, [1.0] * 16, 1)])


def test_empty_and_bad_lengths(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 2), (2, [], 2)]) == []
    rows = [(i, [float(i)] * 8, 1) for i in range(5)]
    assert run(spark, [*rows, (9, [1.0] * 7, 1)]) == plain(rows)
    with pytest.raises(ValueError):
        run(spark, [(1, [1.0] * 9, 1)])


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(9)
    entries = rng.integers(-900, 900, (16, 8))
    points = entries[rng.integers(0, 16, 4000)] + rng.integers(-60, 60, (4000, 8))
    pivots = entries[V.far_apart(entries, V.PIVOTS)]
    found = V.nearest(points, V.distances(points, pivots), entries, V.distances(entries, pivots))
    all_d = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert (found.entry == all_d.argmin(1)).all() and (found.error == all_d.min(1)).all()
    assert found.evaluated < 0.4 * all_d.size


def test_hot_label(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f32(rng.normal(size=8)), 7 if i % 3 else i) for i in range(200)]
    assert run(spark, rows) == plain(rows)
