"""Trie of the prefixes of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is the head of a base conversation followed by its own
turns from some place on.  Its text is never put together: a sequence of turns
is the monoid element (length, hash), and

    (n, x) * (m, y) = (n + m, x + r**n * y)   modulo the prime 2**31 - 1,

in four lanes with a base ``r`` each (124 bits).  A turn is the element of its
content's SHA-256.  With the running products of every *original* conversation,
the prefix of a rebuilt one is the product of a base's head and of a stretch of
its own turns; the latter is a difference of two running products, moved by a
power of ``r``, so a prefix costs a few multiplications.

Running products are scanned over turns that are range-partitioned on
(conversation, turn): a task scans its stretch, the last products of the tasks
(one row each) are chained, and what a task lacks from the left is multiplied
in.  So a conversation with very many turns is spread over tasks.

Rows of equal (depth, fingerprint) form a node, and each row refers to the
stored turn that ends its prefix, by content digest.  If all references of a
node agree, all its members' parents have the same fingerprint too, as the last
turn can be taken off; as this is checked at all nodes, members are equal turn
by turn.  Should a node disagree, all is done anew with other bases.

Sums over subtrees need no walk of the trie.  A node belongs to its smallest
member ``c``; what a conversation owns is the lower end of its path, from some
depth on.  Each node below ``v`` is owned by exactly one member of ``v``, so
children, leaves and lengths of distinct nodes below ``v`` are sums over the
members of ``v``, each knowing from which depth on it owns.

Defined results: rows with a null conversation id are left out.  Turns are
ordered by turn (null first), equal ones by the digest of their content;
repeated rows are repeated turns.  Null role or text counts as empty.  The base
of ``c`` is the next multiple of ``group`` at or below it (also of a negative
one).  An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.llm.attach import attach
from inkline.llm.columnar import text_buffer
from inkline.llm.scratch import written

PRIME = (1 << 31) - 1
LANES = 4
H = [f"h{k}" for k in range(LANES)]
NODE = ["depth", "k1", "k2"]
#: Characters of the member list that go through the shuffle as one row.
CHUNK = 1 << 16


def bases(attempt: int) -> list[int]:
    rng = np.random.default_rng(1000 + attempt)
    return [int(x) for x in rng.integers(1 << 20, PRIME - 1, LANES)]


class Powers:
    """r**n of many n, from a table of the low 16 bits and one power for each distinct rest."""

    def __init__(self, r: int):
        self.r = r
        low = np.ones(1 << 16, np.int64)
        size = 1
        while size < len(low):
            low[size:2 * size] = low[:size] * pow(r, size, PRIME) % PRIME
            size *= 2
        self.low = low

    def __call__(self, n: np.ndarray) -> np.ndarray:
        rest, which = np.unique(n >> 16, return_inverse=True)
        high = np.array([pow(self.r, int(k) << 16, PRIME) for k in rest], np.int64)
        return self.low[n & 0xFFFF] * high[which] % PRIME


def turn_elements(digests: pa.Array) -> np.ndarray:
    """(rows, lanes): a number from 1 to PRIME - 1 for each 32-byte digest."""
    data, _ = text_buffer(digests)
    return data.view("<u4").reshape(-1, 8)[:, :LANES].astype(np.int64) % (PRIME - 1) + 1


SCAN = f"c long, pid int, pos long, {', '.join(f'{h} long' for h in H)}, chars long, n_chars long, digest binary"


def scanned(turns: DataFrame, attempt: int) -> DataFrame:
    """Rows of ``turns`` (c, turn, n_chars, digest) with position, running product and running length within their conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, powers = TaskContext.get().partitionId(), [Powers(r) for r in bases(attempt)]
        last, seen, held, chars = None, 0, np.zeros(LANES, np.int64), 0  # of the conversation that the batch before ended in
        for b in batches:
            if not b.num_rows:
                continue
            c, size = b.column(0).to_numpy(), b.column(1).to_numpy()
            first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            lengths = np.diff(np.append(first, len(c)))
            same = c[0] == last
            place = np.arange(len(c)) - np.repeat(first, lengths)
            place[:lengths[0]] += seen if same else 0
            elements = turn_elements(b.column(2))
            columns = []
            for k in range(LANES):
                running = np.cumsum(elements[:, k] * powers[k](place) % PRIME)  # below 2**31 a row
                before = np.append(0, running)[first]
                before[0] -= held[k] if same else 0
                columns.append((running - np.repeat(before, lengths)) % PRIME)
            running = np.cumsum(size)
            before = np.append(0, running)[first]
            before[0] -= chars if same else 0
            upto = running - np.repeat(before, lengths)
            last, seen, held, chars = c[-1], int(place[-1]) + 1, np.array([x[-1] for x in columns]), int(upto[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(c), pid, np.int32)), pa.array(place + 1), *map(pa.array, columns), pa.array(upto), b.column(1), b.column(2)], ["c", "pid", "pos", *H, "chars", "n_chars", "digest"])

    dealt = turns.repartitionByRange("c", "turn", "digest").sortWithinPartitions("c", "turn", "digest")
    local = written(dealt.select("c", "n_chars", "digest").mapInArrow(run, SCAN), "scan")

    ends = local.groupBy("pid").agg(F.min("c").alias("first"), F.max_by(F.struct("c", "pos", *H, "chars"), F.struct("c", "pos")).alias("end"))
    carries, left = [], None  # left: c, turns, products and length of the conversation that the tasks before ended in
    for row in sorted(ends.collect(), key=lambda r: r["pid"]):  # one row a task
        end = (row["end"]["c"], row["end"]["pos"], [row["end"][h] for h in H], row["end"]["chars"])
        if left and left[0] == row["first"]:
            moved = [pow(r, left[1], PRIME) for r in bases(attempt)]
            carries.append((row["pid"], left[0], left[1], *left[2], *moved, left[3]))
            if end[0] == left[0]:
                end = (end[0], end[1] + left[1], [(x + m * y) % PRIME for x, m, y in zip(left[2], moved, end[2], strict=True)], end[3] + left[3])
        left = end
    if not carries:
        return local.drop("pid")
    columns = "pid int, c long, n0 long, " + ", ".join(f"{p}{k} long" for p in "xm" for k in range(LANES)) + ", chars0 long"
    lacking = F.broadcast(local.sparkSession.createDataFrame(carries, columns))
    whole = local.join(lacking, ["pid", "c"], "left")
    product = [F.when(F.col("n0").isNull(), F.col(h)).otherwise((F.col(f"x{k}") + F.col(f"m{k}") * F.col(h)) % PRIME).alias(h) for k, h in enumerate(H)]
    zero = F.lit(0).cast("long")
    return whole.select("c", (F.col("pos") + F.coalesce("n0", zero)).alias("pos"), *product, (F.col("chars") + F.coalesce("chars0", zero)).alias("chars"), "n_chars", "digest")


def _packed(lanes: list[Column]) -> list[Column]:
    """Four numbers of 31 bits as the two halves of a node's key."""
    return [F.shiftleft(lanes[0], 31).bitwiseOR(lanes[1]).alias("k1"), F.shiftleft(lanes[2], 31).bitwiseOR(lanes[3]).alias("k2")]


def rebuilt(own: DataFrame, attempt: int, group: int, head_limit: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, length, total characters) and their prefixes: c, node key, characters before and in the last turn, its digest, whether more follows."""
    zero = F.lit(0).cast("long")
    short = F.when(F.col("pos") < head_limit, F.struct("pos", *H, "chars", "n_chars", "digest"))
    convs = written(own.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("own_chars"), F.sort_array(F.collect_list(short)).alias("head")), "convs")
    other = convs.select(F.col("c").alias("b"), F.col("head").alias("base_head"))
    named = convs.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % head_limit).withColumn("base", F.col("c") - F.pmod("c", F.lit(group)))
    both = named.join(other, named["base"] == other["b"], "left").withColumn("taken", F.least("h", F.coalesce(F.size("base_head"), F.lit(0)).cast("long")))
    both = both.withColumn("taken", F.when(F.col("base_head").isNull(), zero).otherwise(F.col("taken")))

    def at(head: str, place: str, name: str) -> Column:
        """Running value after ``place`` turns."""
        return F.when(F.col(place) > 0, F.get(F.col(head), F.col(place).cast("int") - 1)[name]).otherwise(zero)

    follows = F.col("n") > F.col("h")
    powers = [F.array(*(F.lit(pow(pow(r, -1, PRIME), k, PRIME)) for k in range(head_limit))) for r in bases(attempt)]
    gap = (F.col("h") - F.col("taken")).cast("int")
    consts = [at("base_head", "taken", h).alias(f"x{k}") for k, h in enumerate(H)] + [F.when(follows, at("head", "h", h)).otherwise(zero).alias(f"y{k}") for k, h in enumerate(H)]
    consts += [F.get(p, gap).cast("long").alias(f"m{k}") for k, p in enumerate(powers)]
    skipped = F.when(follows, at("head", "h", "chars"))
    known = both.select("c", "n", "h", "taken", (F.col("taken") + F.when(follows, F.col("n") - F.col("h")).otherwise(zero)).alias("length"),
                        at("base_head", "taken", "chars").alias("head_chars"), F.coalesce(skipped, zero).alias("skipped"),
                        (at("base_head", "taken", "chars") + F.coalesce(F.col("own_chars") - skipped, zero)).alias("total"),
                        F.slice("base_head", F.lit(1), F.col("taken").cast("int")).alias("base_head"), *consts)
    known = written(known, "rebuilt")

    columns = ["c", *NODE, "before", "n_chars", "digest", "more"]
    nothing = F.lit(None).cast("binary").alias("digest")
    roots = known.select("c", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("before"), zero.alias("n_chars"), nothing, (F.col("length") > 0).alias("more"))
    heads = known.select("c", "length", F.explode("base_head").alias("t")).select(
        "c", F.col("t.pos").alias("depth"), *_packed([F.col(f"t.{h}") for h in H]), (F.col("t.chars") - F.col("t.n_chars")).alias("before"), "t.n_chars", "t.digest", (F.col("length") > F.col("t.pos")).alias("more"))
    moved = attach(own, known.drop("base_head"), ["c"], "n").filter("pos > h")
    product = [(F.col(f"x{k}") + F.col(f"m{k}") * F.pmod(F.col(h) - F.col(f"y{k}"), F.lit(PRIME))) % PRIME for k, h in enumerate(H)]
    depth = F.col("pos") - F.col("h") + F.col("taken")
    tails = moved.select("c", depth.alias("depth"), *_packed(product), (F.col("head_chars") + F.col("chars") - F.col("n_chars") - F.col("skipped")).alias("before"), "n_chars", "digest", (F.col("length") > depth).alias("more"))
    rows = roots.select(columns).unionByName(heads.select(columns)).unionByName(tails.select(columns))
    return known.select("c", "length", "total"), written(rows, "prefixes")


class Trie(NamedTuple):
    """``nodes``: node key, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens; ``ends``: c and the key of the node it ends in."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(turns: DataFrame, group: int = 100, head_limit: int = 6) -> Trie:
    """Nodes of all prefixes of the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Conversation c begins with the first ``crc32(c) % head_limit`` turns of c's multiple of ``group``; its own first turns, as many, are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    narrow = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("c"), "turn", F.length(text).cast("long").alias("n_chars"), F.unhex(F.sha2(content, 256)).alias("digest"))
    narrow = written(narrow, "turns")
    attempt = 0
    while True:
        own = written(scanned(narrow, attempt), "own")
        convs, rows = rebuilt(own, attempt, group, head_limit)
        first = written(rows.groupBy(*NODE).agg(F.min("c").alias("conv_id"), F.max("more").alias("more"), F.min("n_chars").alias("n_chars"), F.min("digest").alias("low"), F.max("digest").alias("high")), "nodes")
        if first.filter("low <> high").isEmpty():
            break
        attempt += 1
    owned = first.groupBy("conv_id").agg(F.min("depth").alias("owns"), F.max((~F.col("more")).cast("long")).alias("leaf"), F.sum("n_chars").alias("owned"), F.count(F.lit(1)).alias("n_nodes"))
    stats = written(convs.join(owned, convs["c"] == owned["conv_id"], "left").select("c", "owns", "leaf", "owned", "n_nodes", "total", (F.col("length") + 1).alias("rows")), "stats")
    known = written(attach(rows, stats, ["c"], "rows"), "known")
    below = F.when(F.col("owns") <= F.col("depth"), F.col("total") - F.col("before")).otherwise(F.coalesce("owned", F.lit(0)))
    nodes = written(known.groupBy(*NODE).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count(F.when(F.col("more") & (F.col("owns") <= F.col("depth") + 1), 1)).alias("n_children"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"), (F.sum(F.col("total") - F.col("before")) - F.sum(below)).alias("saved_tokens")), "sums")

    # the first node that a conversation owns hangs below a node of another one; the rest below its own
    hangs = written(known.filter("owns = depth + 1").select("c", *NODE, "n_nodes"), "hangs")
    above = written(hangs.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n")).join(nodes.select(*NODE, F.col("conv_id").alias("above")), NODE), "above")
    under = written(attach(hangs, above, NODE, "n").select(F.col("c").alias("conv_id"), (F.col("depth") + 1).alias("owns"), "above", "n_nodes"), "under")
    placed = attach(nodes, under, ["conv_id"], "n_nodes")
    parent = F.when(F.col("depth") == 0, F.lit(None).cast("long")).when(F.col("depth") == F.col("owns"), F.col("above")).otherwise(F.col("conv_id"))
    return Trie(placed.select(*NODE, "conv_id", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"), known.filter("NOT more").select("c", *NODE))


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """Index of each first row of equal keys, and the number of rows."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)


def ends_digests(ends: DataFrame) -> DataFrame:
    """Node key and SHA-256 of its members' ids, ascending and joined by commas.

    Ids are sorted by range and joined to strings of up to ``CHUNK`` characters where they lie; a digest is sequential by nature, so only those strings of one node stream through one task.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            depth, k1, k2, c = (b.column(k).to_numpy() for k in range(4))
            cuts = _runs([depth, k1, k2])
            cuts = np.unique(np.concatenate((cuts, np.arange(0, len(c), CHUNK // 20)))) if len(c) else cuts
            first = cuts[:-1]
            texts = [",".join(map(str, c[lo:hi].tolist())) for lo, hi in zip(first, cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (depth, k1, k2, c)] + [pa.array(texts, pa.string())], [*NODE, "c", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            for *key, ids in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if key == node:
                    state.update(f",{ids}".encode())
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], pa.string() if k == 3 else pa.int64()) for k in range(4)], [*NODE, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], [*NODE, "ends_sha256"])

    key = "depth long, k1 long, k2 long"
    parts = ends.select(*NODE, "c").repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c").mapInArrow(joined, f"{key}, c long, ids string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "c").select(*NODE, "ids").mapInArrow(hashed, f"{key}, ends_sha256 string")


def trie_report(turns: DataFrame, group: int = 100, head_limit: int = 6) -> DataFrame:
    """The nodes, with the digest of the conversations that end in each."""
    trie = prefix_trie(turns, group, head_limit)
    none = hashlib.sha256(b"").hexdigest()
    full = trie.nodes.join(ends_digests(trie.ends), NODE, "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
