"""The stages against brute force, each on its own input."""
import re

import public_tokenizers as P
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from inkline.llm import quality_rules

from .test_dedup import brute
from .test_tokens import check_packing

D = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    press = zstandard.ZstdCompressor(level=quality_rules.LEVEL)
    rows = {r.doc_id: r.text for r in docs.collect()}
    rows = {i: t for i, t in rows.items() if quality_rules.judge(t, press)[-1]}
    docs = stages["quality"](spark, docs, D)
    assert {r.doc_id: r.text for r in docs.collect()} == rows

    last = {}
    for i, t in sorted(rows.items()):
        last[t] = i
    rows = {i: t for t, i in last.items()}
    docs = stages["exact_dedup"](spark, docs, D)
    assert {r.doc_id: r.text for r in docs.collect()} == rows

    _, root = brute(list(rows.items()))
    rows = {i: rows[i] for i in root.values()}
    docs = stages["near_dedup"](spark, docs, D)
    assert {r.doc_id: r.text for r in docs.collect()} == rows and docs.columns == columns

    before, docs = rows, stages["pii"](spark, docs, D)
    assert docs.columns == columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    assert set(rows) == set(before)
    for i, t in rows.items():
        for found in re.findall(r"[\w.]+@mail\d\.example\.com|\b\d{16}\b", before[i]):
            assert found not in t
        if not re.search(r"[@\d]", before[i]):
            assert t == before[i]

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    check_packing(stages["packing"](spark, docs, D).collect(), rows, library, 1024)
    check_packing(corpus_pipeline.run(spark, D).collect(), rows, library, 1024)


def test_empty_table_and_edge_rows(spark, tmp_path):
    """Null, empty and short texts go in the first stage; of equal rows one is packed; columns with names used inside stay; a table without rows gives none."""
    press = zstandard.ZstdCompressor(level=quality_rules.LEVEL)
    texts = [r.text for r in spark.read.parquet(f"{D}/documents.parquet").orderBy("doc_id").collect()]
    good = next(t for t in texts if quality_rules.judge(t, press)[-1] and not re.search(r"[@\d=]", t))
    schema = "doc_id long, text string, digest string, place int, `by` string, lang string"
    rows = [(1, good, "a", 1, None, None), (1, good, "a", 1, None, None), (2, good, None, None, "b", "x"), (None, good, "c", 2, None, None),
            (3, None, "a", 1, None, None), (4, "", None, None, None, None), (5, " \n ", "a", 1, "b", "x"), (6, "a b", "a", 1, "b", "x"), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(str(tmp_path / "some" / "documents.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    after = dict(corpus_pipeline.STAGES)["pii"](spark, docs.filter("doc_id = 2"), D).collect()
    check_packing(corpus_pipeline.run(spark, str(tmp_path / "some")).collect(), {2: after[0].text}, library, 1024)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, D).columns == docs.columns, name
