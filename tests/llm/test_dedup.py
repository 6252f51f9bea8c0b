"""Exact dedup and the near-duplicate join against brute force."""
import itertools

import duckdb
import numpy as np
import pytest

from inkline.llm import exact_dedup, ngram_join
from inkline.llm.components import components
from inkline.llm.queries import ORACLE, QUERIES

from .conftest import prose


def order(i):
    return (i is None, i or 0)


def test_exact_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    got = QUERIES["op7_exact_dedup"](spark, d)
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{d}/documents.parquet'")
        want = db.execute(ORACLE["op7_exact_dedup"])
        assert got.columns == [c[0] for c in want.description]
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("heavy", [1, 1024])
def test_exact_edges(edge, nothing, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    groups = {}
    for r in edge.collect():
        groups.setdefault(r.text or "", []).append(r.doc_id)
    rows = exact_dedup.exact_groups(edge).collect()
    assert len(rows) == edge.count()
    best = lambda ids: max(ids, key=lambda i: (i is not None, i or 0))
    assert sorted((order(r.doc_id), order(r.keep_id), r.group_size) for r in rows) == sorted((order(i), order(best(g)), len(g)) for g in groups.values() for i in g)
    assert sum(r.kept for r in rows) == len(groups) and all(r.doc_id == r.keep_id for r in rows if r.kept)
    kept = exact_dedup.drop_copies(edge)
    assert kept.columns == edge.columns
    assert sorted((order(r.doc_id), r.text or "") for r in kept.collect()) == sorted((order(best(g)), t) for t, g in groups.items())
    assert exact_dedup.exact_groups(nothing).count() == exact_dedup.drop_copies(nothing).count() == 0


def shingles(t):
    w = (t or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, similarity=0.8):
    """docs: (id, text) rows. n_links of each text; class id of each text."""
    texts = {t or "" for _, t in docs}
    sets, links = {t: shingles(t) for t in texts}, {t: set() for t in texts}
    for a, b in itertools.combinations(texts, 2):
        shared = len(sets[a] & sets[b])
        if shared and shared >= similarity * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
            links[a].add(b)
            links[b].add(a)
    root = {}
    for t in texts:
        seen, todo = {t}, [t]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        root[t] = min((i for i, x in docs if (x or "") in seen), key=order)
    return {t: len(v) for t, v in links.items()}, root


def near(n_words, seed, changes):
    words = prose(seed, n_words).split()
    for k in changes:
        words[k] = f"other{k}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    docs = [(i, prose(100 + i, 60)) for i in range(40)]
    docs += [(100 + k, near(200, 7, range(0, 5 * (k % 6), 5))) for k in range(12)]
    docs += [(200 + k, near(300, 8, [k])) for k in range(150)]  # a crowd: all similar, none equal
    docs += [(400, near(200, 7, [0]).replace(" ", "\n")), (401, "a b"), (402, "a  b"), (403, "a b c"), (404, None), (405, ""), (406, " ")]
    return docs


@pytest.mark.parametrize("size", [128, 16])
def test_join_equals_brute_force(spark, copies, monkeypatch, size):
    monkeypatch.setattr(ngram_join, "BLOCK", size)
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(3)
    n, root = brute(copies)
    text = dict(copies)
    rows = ngram_join.near_duplicates(df).collect()
    assert len(rows) == len(copies)
    for r in rows:
        t = text[r.doc_id] or ""
        assert (r.n_links, r.class_id) == (n[t], root[t]), t[:40]
    kept = ngram_join.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_join_edges(edge, nothing):
    rows = edge.select("doc_id", "text").collect()
    n, root = brute([tuple(r) for r in rows])
    got = ngram_join.near_duplicates(edge).collect()
    assert sorted((order(r.doc_id), order(r.class_id), r.n_links) for r in got) == sorted((order(r.doc_id), order(root[r.text or ""]), n[r.text or ""]) for r in rows)
    kept = ngram_join.keep_one(edge)
    assert kept.columns == edge.columns and len(kept.collect()) == len({root[r.text or ""] for r in rows})
    assert ngram_join.near_duplicates(nothing).count() == ngram_join.keep_one(nothing).count() == 0


def test_links_are_exact(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string")
    join = ngram_join.jaccard_join(df)
    text, first = dict(copies), {r.c: r.id for r in join.classes.collect()}
    links = ngram_join.links(join).collect()
    for r in links:
        a, b = shingles(text[first[r.a]]), shingles(text[first[r.b]])
        assert r.a < r.b and r.jaccard == pytest.approx(len(a & b) / len(a | b)) and r.jaccard >= 0.8
    assert len({(r.a, r.b) for r in links}) == len(links)


def test_matrix_equals_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.choice(10**6, 200, replace=False)
    own = [np.unique(np.append(rng.choice(base, int(rng.integers(150, 200)), replace=False), rng.integers(10**6, 10**7, 5))) for _ in range(40)]
    shared, block = [np.array([k % 3, 7]) for k in range(40)], np.zeros(40, int)
    fast = ngram_join.linked_pairs(own, shared, block, 0.8)
    monkeypatch.setattr(ngram_join, "MATRIX", 0)
    slow = ngram_join.linked_pairs(own, shared, block, 0.8)
    assert len(fast[0]) and all((x == y).all() for x, y in zip(fast, slow, strict=True))
    block[20:] = 1
    i, j, _ = ngram_join.linked_pairs(own, shared, block, 0.8)
    assert set(zip(i, j, strict=True)) == {(a, b) for a, b in zip(*slow[:2], strict=True) if a < 20 <= b}
    assert sorted(ngram_join.forest(np.array([0, 1, 2, 5]), np.array([1, 2, 0, 6]))) == [(0, 1), (1, 2), (5, 6)]


def test_depth_follows_recall():
    deep = ngram_join.depth_for(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** deep) ** ngram_join.TREES >= 0.9999 > 1 - (1 - 0.8 ** (deep + 1)) ** ngram_join.TREES
    assert ngram_join.depth_for(0.8, 0.999999) < deep
    with pytest.raises(ValueError):
        ngram_join.depth_for(0.3, 0.9999)


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(int(a), int(b)) for a, b in rng.integers(200, 260, (40, 2)) if a != b]
    root = {x: x for e in edges for x in e}
    for _ in range(70):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r.node: r.root for r in components(df).collect()} == root
    assert components(df.limit(0)).count() == 0
