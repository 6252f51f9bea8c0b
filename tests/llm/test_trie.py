"""The trie of rebuilt conversations against a plain one in Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from inkline.llm import prefix_trie as P

COLUMNS = "conv_id long, turn long, role string, text string, depth int, k1 string, more int"


def plain(rows):
    def content(role, text):
        role, text = role or "", text or ""
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, *content(role, text)))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(full) + 1):
            members.setdefault(full[:d], []).append((c, d == len(full)))
    out = {}
    for node in sorted(members, key=len, reverse=True):
        cs = [c for c, _ in members[node]]
        kids = out.setdefault(node, {"children": 0, "leaves": 0, "saved": 0})
        kids["leaves"] = kids["leaves"] or 1
        kids["saved"] += (len(cs) - 1) * len(node[-1][1]) if node else 0
        ends = ",".join(map(str, sorted(c for c, last in members[node] if last)))
        kids["row"] = (min(cs), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(cs), kids["children"], kids["leaves"], kids["saved"], hashlib.sha256(ends.encode()).hexdigest())
        if node:
            up = out.setdefault(node[:-1], {"children": 0, "leaves": 0, "saved": 0})
            up["children"] += 1
            up["leaves"] += kids["leaves"]
            up["saved"] += kids["saved"]
    return sorted((k["row"] for k in out.values()), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], COLUMNS)
    return sorted((tuple(r) for r in P.trie_report(df).collect()), key=str)


def some(seed, convs, texts):
    rnd = random.Random(seed)
    ids = rnd.sample(range(0, 450), convs) + [-7, -100, 10**12]
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(texts)) for c in ids for t in range(rnd.randint(1, 9))]
    rnd.shuffle(rows)
    return rows


def test_trie_equals_plain(spark):
    rows = some(1, 120, ["a", "bb", "é漢😀", "user:a"]) + [(5, None, None, None), (5, None, "", "z"), (None, 1, "user", "x"), (7, 3, None, None), (7, 3, None, None), (7, 3, "user", "")]
    assert run(spark, rows) == plain(rows)


def test_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in P.trie_report(df).collect()), key=str) == plain(rows)


def test_long_and_equal_conversations_over_many_tasks(spark):
    rows = [(3, t, "user", f"t{t % 7}") for t in range(900)]  # a third of all rows in one conversation
    rows += [(c, t, "user", "same") for c in range(100, 400) for t in range(6)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_empty_and_turnless(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "a", "b")]) == []
    alone = [(c, 0, "user", "only") for c in (101, 102, 103, 104)]  # shorter than what they leave out, without a base
    assert run(spark, alone) == plain(alone)


@pytest.mark.parametrize("n", [0, 1, 65535, 65536, 10**9])
def test_powers(n):
    r = P.bases(0)[0]
    assert P.Powers(r)(np.array([n, n + 1])).tolist() == [pow(r, n, P.PRIME), pow(r, n + 1, P.PRIME)]


def test_disagreeing_references_start_anew(spark, monkeypatch):
    """With bases that let sequences collide, the check finds it and other bases are taken."""
    true, tried = P.bases, []
    monkeypatch.setattr(P, "bases", lambda attempt: [1] * P.LANES if attempt == 0 else (tried.append(attempt), true(attempt))[1])
    rows = [(101, 0, "u", "a"), (102, 0, "u", "b")] + [(c, t, "u", x) for c in range(200, 230) for t, x in enumerate("ab" * 4 if c % 2 else "ba" * 4)]
    assert run(spark, rows) == plain(rows) and tried
