"""Token counts, the BPE codec and packing against the libraries."""
import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from inkline.llm import packing, piece_codec, pretokens
from inkline.llm.bpe import bpe_decode, bpe_digests, bpe_encode, pieces
from inkline.llm.columnar import text_buffer
from inkline.llm.queries import QUERIES
from inkline.llm.token_counts import count_tokens, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
PARTS = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\t", "a", "aaaa", "B", "é", "1", "٣", "!", "?", "漢", "😀", "<|endoftext|>", "<|endof", "՘", "\x00", "\x85", "　", "abab", "the", "ing"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + ["", "a" * 20_000, "ab1 " * 4000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_split_equals_pattern(texts):
    data, ends = text_buffer(pa.array(texts))
    cut, raw = pretokens.split(data, ends), data.tobytes()
    pattern = regex.compile(P.PATTERN)
    for i, t in enumerate(texts):
        assert [raw[cut.starts[k]:cut.starts[k + 1]].decode() for k in range(cut.rows[i], cut.rows[i + 1])] == pattern.findall(t)


def test_counts_equal_library(texts, library):
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert count_tokens(pa.array([*texts, None]), JSON).tolist() == [*want, 0]


def test_codec_round_trip(texts, library, tik):
    array = pa.array(texts)
    for codec, encode in ((piece_codec.from_json(JSON), lambda t: library.encode(t, add_special_tokens=False).ids), (piece_codec.from_ranks(RANKS), tik.encode_ordinary)):
        for s in codec.slices(array):
            back, ends = codec.decode(s.ids, s.rows)
            assert (back == s.data).all() and (ends == s.ends).all()
            for i in range(s.hi - s.lo):
                ids = s.ids[s.rows[i]:s.rows[i + 1]]
                assert ids.tolist() == encode(texts[s.lo + i])
                if i % 40 == 0:
                    assert "".join(pieces(codec, ids)) == texts[s.lo + i]


def test_offsets_equal_library(texts, library):
    codec = piece_codec.from_json(JSON)
    for s in codec.slices(pa.array(texts[:1500])):
        begin, end = codec.offsets(s.ids, s.data, s.ends, s.rows)
        for i in range(s.hi - s.lo):
            at = slice(s.rows[i], s.rows[i + 1])
            assert list(zip(begin[at], end[at], strict=True)) == library.encode(texts[s.lo + i], add_special_tokens=False).offsets


def test_store_starts_anew(monkeypatch, texts, tik):
    monkeypatch.setattr(piece_codec, "STORE", 50)
    codec = piece_codec.from_ranks.__wrapped__(RANKS)
    for part in (texts[:500], texts[500:900], texts[:500]):
        for s in codec.slices(pa.array(part)):
            for i in range(s.hi - s.lo):
                assert s.ids[s.rows[i]:s.rows[i + 1]].tolist() == tik.encode_ordinary(part[s.lo + i])


def test_edges(edge, nothing, library, tik):
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, str(r))
    rows = sorted(edge.select("doc_id", "text").collect(), key=key)
    counts = token_counts(edge, JSON).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in counts) == sorted((r.doc_id or -1, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 512) for r in rows)
    digest = lambda t: (hashlib.sha256(np.array(tik.encode_ordinary(t), "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert sorted((r.doc_id or -1, r.ids_sha256, r.decoded_sha256) for r in bpe_digests(edge, RANKS).collect()) == sorted((r.doc_id or -1, *digest(r.text or "")) for r in rows)
    back = bpe_decode(bpe_encode(edge, RANKS), RANKS, with_pieces=True).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r.doc_id or -1, r.text or "") for r in rows)
    assert all("".join(r.pieces) == r.text and bytes(r.bytes).decode() == r.text for r in back)
    for result in (token_counts(nothing, JSON), bpe_encode(nothing, RANKS), bpe_digests(nothing, RANKS), packing.pack(nothing, JSON)):
        assert result.count() == 0


def test_split_characters(spark):
    codec = piece_codec.from_ranks(RANKS)
    ids = next(codec.slices(pa.array(["😀"]))).ids
    assert len(ids) > 1 and pieces(codec, ids)[:-1] == [""] * (len(ids) - 1) and pieces(codec, ids)[-1] == "😀"
    row = bpe_decode(spark.createDataFrame([(1, ids[:1].tolist()), (2, None)], "doc_id long, ids array<int>"), RANKS).orderBy("doc_id").collect()
    assert row[0].text == "�" and row[1].text == "" and bytes("😀", "utf-8").startswith(row[0]["bytes"])


def check_packing(rows, docs, library, window):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for doc, found in by_doc.items():
        ids = np.array([*library.encode(docs[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    open_ = 0
    for found in by_sequence.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == [0, *np.cumsum([r.length for r in found])[:-1]]
        total = sum(r.length for r in found)
        assert total <= window
        open_ += total < window
    return open_


def test_packing(spark, library):
    rnd = random.Random(4)
    docs = {i: "ab " * rnd.choice([0, 1, 5, 60, 700, 1024, 3000]) for i in range(300)} | {300: None}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    for most in (4096, 3):
        rows = packing.pack(df, JSON, max_open=most).collect()
        assert check_packing(rows, docs, library, 1024) <= 3  # one padded sequence for each partition
    with_ids = packing.pack(df, JSON, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)


def test_packing_minimises_squares():
    """Each placement against trying every level."""
    rnd, packer, window = random.Random(8), packing.Packer(32, 10**6), 32
    for _ in range(600):
        size, before = rnd.randint(1, 31), packer.level.copy()
        packer.place(packing.Piece(0, 0, np.zeros(size, np.int32), size))
        cost = lambda n: int((n[1:] ** 2).sum())
        options = []
        for h in range(window - size + 1):
            if h == 0 or before[h]:
                n = before.copy()
                if h:
                    n[h] -= 1
                if h + size < window:
                    n[h + size] += 1
                options.append(cost(n))
        assert cost(packer.level) == min(options)


def test_queries(spark):
    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    assert QUERIES["op2_bpe"](spark, d).count() == QUERIES["op4_token_counts"](spark, d).count() == n
    assert QUERIES["op10_packing"](spark, d).select("doc_id").distinct().count() == n
