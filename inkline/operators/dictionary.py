"""Dictionary match (T1): every term that is a substring of the text.

Case- and accent-sensitive, no word boundary, results in dictionary order,
joined by ``', '`` (``''`` when nothing matches).

One strategy for a dictionary of any size: an equi-join on grams.  Terms fall
into classes by length (1, 2-3, 4-7, 8-15, ...), each with its own gram length
g and stride s = shortest + 1 - g in bytes, so that every occurrence of a term covers
a gram of the text that starts at a multiple of s.  Texts emit those grams
together with the window around them that a term of the class can reach, so a
candidate is verified where it is found and no text is joined back.  Terms
emit a gram for each of the s offsets.  AQE broadcasts the term side if it
measures it as small, and splits hot grams otherwise.  No term is capped.

Matches belong to a text, not to an id, so equal or NULL ids don't matter:
each row gets the matches of its own text.

``match_inline`` is the projection for a list of terms that the caller holds
anyway (a source's place names); it gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_inline(text: Column, terms: list[str]) -> Column:
    """Matched terms in dictionary order, as an array (empty terms never match)."""
    terms = [t for t in terms if t]
    if not terms:
        return F.array().cast("array<string>")
    # ``contains`` (first-byte scan) rather than ``instr`` (character-position scan)
    return F.array_compact(F.array(*[F.when(text.contains(t), F.lit(t)) for t in terms]))


def join_matches(matched: Column) -> Column:
    """``', '``-joined matches, ``''`` when there is none."""
    return F.array_join(F.coalesce(matched, F.array().cast("array<string>")), ", ")


def gram_and_stride(shortest: int) -> tuple[int, int]:
    """Gram length and stride for terms of ``shortest`` characters or more."""
    g = max(min(shortest, 4), shortest // 2)
    return g, shortest - g + 1


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


#: Bytes of a chunk of a text; bounds the list of places that one row holds.
CHUNK = 1 << 16


def _by_class(values: dict[int, int]) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(F.col("k") == k, v) if out is None else out.when(F.col("k") == k, v)
    return out


def text_matches(texts: DataFrame, dictionary: DataFrame, text: str = "text", term: str = "term", order: str = "ord") -> DataFrame:
    """Distinct (text_key, ord, term): which terms each text holds."""
    terms = (dictionary.select(F.col(order).alias("ord"), F.col(term).alias("term"), F.col(term).cast("binary").alias("raw"))
             .filter(F.length("raw") > 0).withColumn("m", F.length("raw")).withColumn("k", F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int")))
    longest = {r["k"]: r["m"] for r in terms.groupBy("k").agg(F.max("m").alias("m")).collect()}  # a row per length class
    spark = texts.sparkSession
    if not longest:
        return spark.createDataFrame([], f"text_key binary, ord {terms.schema['ord'].dataType.simpleString()}, term string")
    shapes = {k: gram_and_stride(1 << k) for k in longest}
    reach, back = max(longest.values()), max(s for _, s in shapes.values())
    size = max(CHUNK, 2 * reach)  # bytes: in UTF-8 a term is in a text where its bytes are, and a place in bytes is found at once
    body = F.col(text).cast("binary")
    starts = F.when(F.length(body) > 0, F.sequence(F.lit(0), F.length(body) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    chunk = F.transform(starts, lambda c: F.struct(c.alias("start"), F.least(c, F.lit(back)).alias("margin"),
                                                   F.substring(body, c - F.least(c, F.lit(back)) + 1, F.least(c, F.lit(back)) + size + reach).alias("piece")))
    pieces = texts.select(text_key(F.col(text)).alias("text_key"), F.length(body).alias("n"), F.explode(chunk).alias("x")).select("text_key", "n", "x.*")
    places = []
    for k, (g, s) in sorted(shapes.items()):  # a place of class k in its chunk is k * size + its offset
        first, last = F.pmod(-F.col("start"), F.lit(s)), F.least(F.lit(size - 1), F.col("n") - g - F.col("start"))
        places.append(F.when(last >= first, F.sequence(first + k * size, last + k * size, F.lit(s))).otherwise(F.array().cast("array<int>")))
    grams = pieces.select("text_key", "start", "margin", "piece", F.explode(F.concat(*places)).alias("place"))
    gram, stride = _by_class({k: g for k, (g, _) in shapes.items()}), _by_class({k: s for k, (_, s) in shapes.items()})
    grams = grams.select("text_key", "piece", F.floor(F.col("place") / size).cast("int").alias("k"), (F.col("place") % size + F.col("margin")).alias("at"), (F.col("place") % size + F.col("start")).alias("p"))
    grams = grams.withColumn("before", F.least(F.col("p"), stride - 1))
    grams = grams.select("text_key", "k", "before", F.substring("piece", F.col("at") + 1, gram).alias("gram"),
                         F.substring("piece", F.col("at") - F.col("before") + 1, F.col("before") + _by_class(longest)).alias("window"))
    anchors = terms.withColumn("off", F.explode(F.sequence(F.lit(0), stride - 1)))
    anchors = anchors.select("k", F.substring("raw", F.col("off") + 1, gram).alias("gram"), "ord", "term", "raw", "m", "off")
    return (grams.join(anchors, ["k", "gram"])
            .filter((F.col("off") <= F.col("before")) & (F.substring("window", F.col("before") - F.col("off") + 1, F.col("m")) == F.col("raw")))
            .select("text_key", "ord", "term").distinct())


def match_pairs(docs: DataFrame, dictionary: DataFrame, doc_id: str = "doc_id", text: str = "text", term: str = "term", order: str = "ord") -> DataFrame:
    """(doc_id, ord, term) for every row of ``docs`` and every term that its text holds."""
    found = text_matches(docs, dictionary, text, term, order)
    return docs.select(F.col(doc_id), text_key(F.col(text)).alias("text_key")).join(found, "text_key").select(doc_id, "ord", "term")


def matches_of(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "matches") -> DataFrame:
    """One row per row of ``docs``: its id and its text's matches (``text_matches``) joined by ', '."""
    per_text = found.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("ord", "term"))).alias("_m"))
    return (docs.select(F.col(doc_id), text_key(F.col(text)).alias("text_key")).join(per_text, "text_key", "left")
            .select(doc_id, join_matches(F.transform("_m", lambda s: s["term"])).alias(out)))


def match_by_join(docs: DataFrame, dictionary: DataFrame, doc_id: str = "doc_id", text: str = "text", term: str = "term", order: str = "ord", out: str = "matches") -> DataFrame:
    """T1 + T1b: one row per row of ``docs``: its id and its matches joined by ', '."""
    return matches_of(docs, text_matches(docs, dictionary, text, term, order), doc_id, text, out)
