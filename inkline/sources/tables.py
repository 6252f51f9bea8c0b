"""Sources: page tables, dictionaries, stopwords, seeds, and the article schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Output columns, in the order of the table's insert list.
ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("subtitle", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("media", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("clean_title", T.StringType()),
    T.StructField("clean_subtitle", T.StringType()),
    T.StructField("clean_body", T.StringType()),
    T.StructField("comunas", T.StringType()),
    T.StructField("category_1", T.StringType()),
    T.StructField("category_2", T.StringType()),
    T.StructField("gore", T.IntegerType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("pos", T.DoubleType()),
    T.StructField("neu", T.DoubleType()),
    T.StructField("neg", T.DoubleType()),
])

# --- end of fixed values ----------------------------------------------------
ARTICLE_COLUMNS = tuple(ARTICLE_SCHEMA.fieldNames())

RAW_PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("media", T.StringType()),
    T.StructField("crawl_seq", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A page table ``(page_id, url, html, ...)``.

    ``parquet`` / ``json`` read columns as stored (the scan prunes ``html``
    when a query does not need it).  ``html`` reads raw files one page per
    file (``wholetext``): the file path becomes the URL, which is the key of
    such a page; ``page_id`` numbers the rows of one read.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.json(path)
    if fmt == "html":
        raw = spark.read.option("wholetext", True).text(path)
        src = F.input_file_name()
        return raw.select(F.monotonically_increasing_id().alias("page_id"), src.alias("url"), F.col("value").alias("html"))
    raise ValueError(f"unknown page format {fmt!r}")


def read_dictionary(spark: SparkSession, path: str, fmt: str = "csv", column: str = "term") -> DataFrame:
    """An ordered term list ``(ord, term)``; files carry both columns, as line order isn't kept over splits."""
    if fmt == "csv":
        return spark.read.option("header", True).schema(f"ord BIGINT, {column} STRING").csv(path).select("ord", F.col(column).alias("term"))
    if fmt in ("parquet", "json"):
        return spark.read.format(fmt).load(path).select(F.col("ord").cast("bigint").alias("ord"), F.col(column).alias("term"))
    raise ValueError(f"unknown dictionary format {fmt!r}")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """S3: a stopword file, one word per line, as a table of distinct words."""
    word = F.trim(F.col("value"))
    return spark.read.text(path).select(word.alias("word")).filter("word <> ''").distinct()


def seeds_frame(spark: SparkSession, seeds: dict[str, Iterable[str]]) -> DataFrame:
    """``(media, url)`` rows of the start URLs, round 0 of the crawl closure."""
    rows = [(m, u) for m, urls in seeds.items() for u in urls]
    return spark.createDataFrame(rows, "media string, url string")


def conform_articles(df: DataFrame, key: str | None = None) -> DataFrame:
    """Exactly the declared article fields, in order, with their types.

    A field the input lacks becomes a typed NULL; an undeclared input column is
    dropped (a record can only hold declared fields).
    """
    cols = []
    for f in ARTICLE_SCHEMA.fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    out = df.select(*([F.col(key)] if key else []), *cols)
    return out
