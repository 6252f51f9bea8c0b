"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  Every stage works on all that its predecessor kept,
and all but the last return the columns of documents.  Between stages the
rows may be written and read again; ``run`` writes them to the shared scratch
folder, so that no stage is computed twice and a lost executor costs one
stage's tasks at most.

Defined results: a null, empty or short text is rejected by the first stage;
given to a later one, null counts as empty where texts are compared, stays
null in ``pii`` and is packed as its end id alone.  Rows with a null id are
documents like others, equal rows leave one, further columns come along
whatever their names, and a table without rows gives none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inkline.llm.exact_dedup import drop_copies
from inkline.llm.ngram_join import keep_one
from inkline.llm.packing import pack
from inkline.llm.pii import anonymise
from inkline.llm.quality_rules import keep_good
from inkline.llm.queries import pii_key
from inkline.llm.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the row with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 connect, keeps the one with the smallest doc_id."""
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; no document goes."""
    return anonymise(docs, pii_key(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024, end_id=0)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing)]

#: Compression ratios, MinHash candidates and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
