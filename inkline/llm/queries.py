"""Driver queries of the operators: ``opN_<name>`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text of documents in the 50k byte-level vocabulary."""
    from inkline.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents encoded by the 50k ranks and decoded again."""
    from inkline.llm.bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@register
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    from inkline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), window=1024, end_id=0)


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and compression bands of every text of documents."""
    from inkline.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


@register
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of documents, and which row of them stays."""
    from inkline.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, mod n; null where doc_id is."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@register
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text of documents, learned from labels outside the held-out fifth."""
    from inkline.llm import quality_classifier as Q

    docs = table(spark, sf_dir, "documents")
    model = Q.train(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return Q.score(docs, model).withColumn("held_out", F.coalesce(remainder(5) == 0, F.lit(False)))


@register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of documents, learned outside the held-out third."""
    from inkline.llm import language_id as L

    docs = table(spark, sf_dir, "documents")
    model = L.train(docs, remainder(3) != 1)
    return L.identify(docs, model).withColumn("held_out", F.coalesce(remainder(3) == 1, F.lit(False)))


@register
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings alone, formatted and read back."""
    from inkline.llm.chat_format import format_chat, read_back

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.schema)
    return read_back(format_chat(turns.unionByName(extra)))


@register
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose word 5-gram sets have a Jaccard similarity of 0.8 or more."""
    from inkline.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


#: Setting that holds the key of the surrogates, and the key of the test tables; a real run sets a secret one.
PII_SETTING, PII_KEY = "spark.inkline.pii.key", "corpus"


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get(PII_SETTING, PII_KEY)


@register
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents with its personal data replaced by surrogates."""
    from inkline.llm.pii import anonymise

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return anonymise(docs, pii_key(spark), count_col="n_entities")


@register
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part codes of all embeddings, refined by six rounds."""
    from inkline.llm.vector_codes import coded_vectors

    return coded_vectors(table(spark, sf_dir, "embeddings"))


@register
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every text of documents."""
    from inkline.llm.simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"))


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    from inkline.llm.prefix_trie import trie_report

    return trie_report(table(spark, sf_dir, "conversations"))
