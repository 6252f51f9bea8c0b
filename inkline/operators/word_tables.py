"""Enrichment by tables: place names (S2, T1) and stopwords (S3, T2) that needn't fit into an expression.

A small table, by count, becomes the list that the inline functions take.  A
large one is joined: the rows are written once, what is looked up is keyed by
the digest of the text, so equal texts are looked up once, and what comes
back for a text is joined to its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.functions import text as T
from inkline.functions.html import scanned
from inkline.operators.dictionary import join_matches, match_inline, text_key, text_matches
from inkline.session import scratch_path

#: Terms of a list, and stopwords of a list, at most.
INLINE_TERMS = 64
INLINE_WORDS = 10_000
#: Stopwords that are broadcast, at most; more are joined by Spark's own measure.
BROADCAST_WORDS = 2_000_000
#: Stopwords of one text that are tested one by one, at most.
FEW = 16


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_matches(rows: DataFrame, places: DataFrame, text: str = "body", out: str = "comunas") -> DataFrame:
    """T1 + T1b: ``rows`` with the terms of ``places`` (ord, term) that the text holds, in order of ``ord``, joined by ', '."""
    terms = places.filter("term <> ''").select("ord", "term")
    few = terms.orderBy("ord").limit(INLINE_TERMS + 1).collect()
    if len(few) <= INLINE_TERMS:
        return rows.withColumn(out, join_matches(match_inline(F.col(text), [r["term"] for r in few])))
    rows = _written(rows.withColumn("_key", text_key(F.col(text))), "rows")
    texts = rows.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.min(text).alias("text")).select("text")
    found = text_matches(texts, terms).groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("ord", "term"))).alias("_found"))
    both = rows.join(found, rows["_key"] == found["text_key"], "left")
    return both.withColumn(out, join_matches(F.transform("_found", lambda x: x["term"]))).drop("_key", "text_key", "_found")


def without(words: Column, own_stopwords: Column) -> Column:
    """``words`` without those of a text's own stopwords, order and repeats kept.

    A few stopwords are tested one by one.  With more, words and stopwords are
    sorted together, so that a stopword stands before the words that equal it, and
    one pass drops those; what stays is put back in order.
    """
    def merged(own: Column) -> Column:
        tagged = F.concat(F.transform(own, lambda w: F.struct(w.alias("w"), F.lit(0).alias("i"))), F.transform(words, lambda w, i: F.struct(w.alias("w"), (i + 1).alias("i"))))

        def step(s: Column, x: Column) -> Column:
            last = F.when(x["i"] == 0, x["w"]).otherwise(s["state"])
            stays = (x["i"] > 0) & ~F.coalesce(last == x["w"], F.lit(False))
            return F.struct(last.alias("state"), F.when(stays, F.array_append(s["out"], F.struct(x["i"].alias("i"), x["w"].alias("w")))).otherwise(s["out"]).alias("out"))

        none = F.array().cast("array<struct<i:int,w:string>>")
        in_order = lambda found: F.transform(F.array_sort(F.flatten(found)), lambda x: x["w"])
        return T.let(F.array_sort(tagged), lambda p: scanned(p, F.lit(None).cast("string"), none, step, lambda out: out, in_order))

    few = F.filter(words, lambda w: ~F.array_contains(own_stopwords, w))
    return F.when(own_stopwords.isNull(), words).when(F.size(own_stopwords) <= FEW, few).otherwise(merged(own_stopwords))


def with_clean(rows: DataFrame, columns: Mapping[str, str], stopwords: DataFrame) -> DataFrame:
    """T2 with a stopword table (``word``): ``rows`` with the normalised text of each of ``columns`` (from, to).

    Each text's distinct words are joined with the table, and only the
    stopwords that a text holds come back to it; its tokens are not taken apart and
    put together again across the shuffle.
    """
    words = stopwords.select("word").filter(F.col("word").isNotNull()).distinct()
    few = [r[0] for r in words.limit(INLINE_WORDS + 1).collect()]
    if len(few) <= INLINE_WORDS:
        return rows.select("*", *(T.normalize_text(F.col(a), sorted(few)).alias(b) for a, b in columns.items()))
    words = _written(words, "stopwords")
    if words.count() <= BROADCAST_WORDS:
        words = F.broadcast(words)
    rows = _written(rows.select("*", *(text_key(F.col(a)).alias(f"_key_{a}") for a in columns)), "rows")
    texts = rows.select(F.explode(F.array(*(F.struct(F.col(f"_key_{a}").alias("key"), F.col(a).alias("text")) for a in columns))).alias("t"))
    held = texts.filter("t.text IS NOT NULL").select("t.key", F.explode(F.array_distinct(T.alpha_tokens(F.col("t.text")))).alias("word"))
    own = _written(held.join(words, "word").groupBy("key").agg(F.collect_set("word").alias("own")), "own_stopwords")
    for a, b in columns.items():
        of = own.select(F.col("key").alias("_k"), F.col("own").alias("_own"))
        joined = rows.join(of, rows[f"_key_{a}"] == of["_k"], "left")
        rows = joined.withColumn(b, F.array_join(without(T.alpha_tokens(F.col(a)), F.col("_own")), " ")).drop("_k", "_own")
    return rows.drop(*(f"_key_{a}" for a in columns))
