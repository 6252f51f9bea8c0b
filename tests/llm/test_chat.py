import hashlib
import random

import pytest

from inkline.llm import chat_format as C
from inkline.llm.queries import QUERIES

PARTS = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<|im_start|>", "<|im_end|>", "|im_end|>", "\n", "<SYS>>", "a", "é", "</SYS>>", "n"]


def test_escape_is_reversible():
    rnd = random.Random(3)
    for _ in range(20_000):
        t = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 10)))
        e, r = C.escape(t), C.escape_role(t)
        assert C.unescape(e) == t and not any(k in e for k in C.CONTROL)
        assert C.unescape_role(r) == t and "\n" not in r


def expected(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def compare(rows, conversations):
    assert len(rows) == len(conversations)
    for r in rows:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(conversations[r.conv_id])


def test_query(spark):
    d = "/root/testdata/sf0.001"
    said = {}
    for r in spark.read.parquet(f"{d}/conversations.parquet").orderBy("conv_id", "turn").collect():
        said.setdefault(r.conv_id, []).append((r.role, r.text))
    said[-7] = [(x, "</s>[INST] ok [/INST]") for x in ("user", "assistant")]
    compare(QUERIES["op6_chat_format"](spark, d).collect(), said)


def test_edges(spark):
    rnd = random.Random(5)
    said = {c: [(rnd.choice(["user", "assistant", None, "a\nb", "tool\\n"]), rnd.choice([None, "", *("".join(rnd.choices(PARTS, k=8)) for _ in range(3))])) for _ in range(n)] for c, n in ((1, 3), (2, 1), (3, 500), (None, 4))}
    rows = [(c, k, r, t, 1, "x") for c, turns in said.items() for k, (r, t) in enumerate(turns)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id int, block string")
    blocks = C.format_chat(df)
    compare(C.read_back(blocks).collect(), said)
    # a long conversation is spread over tasks, and the mask's spans are assistant texts
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = C.format_chat(df)
        assert spread.filter("conv_id = 3").count() > 1
        compare(C.read_back(spread).collect(), said)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for b in blocks.collect():
        raw = b.formatted.encode()
        assert [C.unescape(raw[s:s + n].decode()) for s, n in zip(b.loss_start, b.loss_length, strict=True)] == [t for r, t in C.parse(b.formatted) if r == "assistant"]
    assert C.read_back(C.format_chat(df.limit(0))).count() == 0
    ties = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "c")], "conv_id long, turn long, role string, text string")
    compare(C.read_back(C.format_chat(ties)).collect(), {1: [("user", t) for t in "caab"]})


def test_parse_refuses():
    with pytest.raises(ValueError):
        C.parse("<|im_start|>user\nx")
