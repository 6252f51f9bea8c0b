"""The article plan: pages -> source -> fields -> rejects -> caps -> recency -> body -> enrichment -> sinks.

One scan serves any number of sources.  Date, cap and recency need the narrow
fields only (the reference enriches first and filters last), so the body is
taken from the container of the pages that survive, and the classifier, the
one Python step, runs last.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.functions import dates as D
from inkline.functions import text as T
from inkline.operators import limits as L
from inkline.operators.dictionary import join_matches, match_inline
from inkline.operators.profiles import Profile, Sources, judged, parsed, with_body
from inkline.operators.word_tables import with_clean, with_matches
from inkline.session import scratch_path
from inkline.sources.tables import ARTICLE_COLUMNS

Profiles = Profile | Mapping[str, Profile]


def selected(pages: DataFrame, profiles: Profiles, as_of: dt.datetime | str) -> DataFrame:
    """W1-W4 + P5: the judged pages that each source emits.

    Cut-offs are found first, on the narrow columns of judged pages; pages
    beyond them are dropped as they are read, before anything is extracted
    from them, and no page's HTML, container or body is shuffled.
    """
    src = Sources(profiles)
    order = F.col("crawl_seq") if "crawl_seq" in pages.columns else F.col("page_id")
    tagged = pages.withColumn("media", src.media().cast("string")).withColumn("crawl_seq", order.cast("bigint"))
    received = src.one.response_cap if src.one else src.value("response_cap")
    caps = src.one.row_cap if src.one else src.value("row_cap")

    def articles_of(rows: DataFrame) -> DataFrame:
        return judged(rows, profiles, with_media=False).filter((F.col("status") == "parsed") & (F.col("part") >= 0))

    if received:
        tagged = L.cap_rows(tagged, received, tiebreak="page_id")
    if caps:
        cuts = L.cut_offs(articles_of(tagged), caps, tiebreak="page_id")
        rows = L.within(articles_of(L.within(tagged, cuts, tiebreak="page_id", exact=False)), cuts, tiebreak="page_id")
    else:
        rows = articles_of(tagged)
    fresh = D.is_fresh(F.col("published_at"), as_of)
    kinds = {None: src.one.freshness} if src.one else src.value("freshness")
    of = lambda kind: F.lit(kind in kinds.values()) if src.one else F.col("media").isin(*(m for m, k in kinds.items() if k == kind))
    if "prefix" in kinds.values():
        rows = L.prefix_stop(rows, ~fresh & of("prefix"))
    return rows.filter(~of("window") | fresh) if "window" in kinds.values() else rows


CLEAN = {"title": "clean_title", "subtitle": "clean_subtitle", "body": "clean_body"}


def enrich(rows: DataFrame, places: Sequence[str] | DataFrame = (), stopwords: Sequence[str] | DataFrame = T.DEFAULT_STOPWORDS,
           phrases: Sequence[str] = T.GORE_PHRASES, sentiment_udf=None) -> DataFrame:
    """One projection, where places (ord, term) and stopwords (word) are lists; tables of them are joined (``word_tables``)."""
    body = F.col("body")
    senti = sentiment_udf(body) if sentiment_udf is not None else T.sentiment_default(body)
    columns = [c for c in rows.columns if c not in ("comunas", *CLEAN.values())]
    if isinstance(places, DataFrame):
        rows = with_matches(rows, places)
    else:
        rows = rows.withColumn("comunas", join_matches(match_inline(body, list(places))))
    if isinstance(stopwords, DataFrame):
        rows = with_clean(rows, CLEAN, stopwords)
    else:
        rows = rows.select("*", *(T.normalize_text(F.col(a), stopwords).alias(b) for a, b in CLEAN.items()))
    return rows.select(
        *columns, "comunas", *CLEAN.values(), T.keyphrase_flag(body, phrases).alias("gore"), senti.alias("_s"),
    ).select("*", F.col("_s.sentiment").alias("sentiment"), F.col("_s.pos").alias("pos"),
             F.col("_s.neu").alias("neu"), F.col("_s.neg").alias("neg")).drop("_s")


def finished(rows: DataFrame, places: Sequence[str] | DataFrame = (), stopwords: Sequence[str] | DataFrame = T.DEFAULT_STOPWORDS,
             phrases: Sequence[str] = T.GORE_PHRASES, classifier: Callable | None = None, sentiment_udf=None,
             keep_key: bool = True) -> DataFrame:
    """Enrichment and, if given, the classifier; columns in sink order (K2), plus ``page_id``."""
    rows = enrich(rows, places, stopwords, phrases, sentiment_udf)
    if classifier is not None:
        from inkline.operators.enrich import classify
        rows = classify(rows, "body", classifier)
    else:
        rows = rows.withColumn("category_1", F.lit("")).withColumn("category_2", F.lit(""))
    return rows.select(*(["page_id"] if keep_key else []), *ARTICLE_COLUMNS)


def articles(pages: DataFrame, profiles: Profiles, as_of: dt.datetime | str, **enrichment) -> DataFrame:
    """The full plan for one source or several; ``enrichment``: arguments of :func:`finished`."""
    rows = with_body(selected(pages, profiles, as_of), profiles)
    return finished(rows, **enrichment)


def all_articles(pages: DataFrame, profiles: Profiles, **enrichment) -> DataFrame:
    """Every article of the pages, without caps and recency."""
    return finished(parsed(pages, profiles), **enrichment)


def rejected(pages: DataFrame, profiles: Profiles) -> DataFrame:
    """Pages that are no article, of unknown hosts too, with their reason."""
    return judged(pages, profiles).filter("status <> 'parsed'").select("page_id", "media", F.col("page_url").alias("url"), "status", "reason")


def run_sinks(pages: DataFrame, profiles: Profiles, as_of: dt.datetime | str, csv_path: str, table_path: str,
              classifier: Callable | None = None, **enrichment) -> None:
    """K4: the sinks in the reference's order; the CSV stage comes before the categories are filled.

    The enriched rows are written once to the shared scratch folder, so neither
    sink parses pages again.
    """
    from inkline.operators.enrich import classify
    from inkline.sources.sinks import idempotent_append, write_csv

    spark = pages.sparkSession
    path = scratch_path(spark, f"articles/{uuid.uuid4().hex}")
    articles(pages, profiles, as_of, **enrichment).write.parquet(path)
    rows = spark.read.parquet(path)
    write_csv(rows, csv_path)
    if classifier is not None:
        rows = classify(rows, "body", classifier)
    idempotent_append(rows, table_path)


REQUIRED = ("title", "subtitle", "body", "published_at", "media", "url")


def require_complete(df: DataFrame, fields: Sequence[str] = REQUIRED, mode: str = "strict") -> DataFrame:
    """Drop rows with a missing or empty required field.

    The reference's check (``v is not None or v != ''``) is always true, so
    ``mode='reference'`` passes everything; ``strict`` applies what it means.
    """
    if mode == "reference":
        return df
    cond = None
    for f in fields:
        c = F.coalesce(F.col(f).cast("string"), F.lit("")) != ""
        cond = c if cond is None else cond & c
    return df.filter(cond)
