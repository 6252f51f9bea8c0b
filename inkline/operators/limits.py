"""Per-source caps and stops (W1-W5) over an explicit crawl order.

The reference counts rows in crawl order inside one process; here the order
is the ``crawl_seq`` column and a cap is a *selection*: :func:`cut_offs` finds
each source's last kept place on rows of a few narrow columns, and
:func:`within` filters the wide rows by that table of one row per source where
they are read.  No wide row is shuffled to be counted.

The selection is distributed.  Ranks are taken within (source, share) and then
within the source, where a share is a 64th of the *tasks*: a task's rows of a
source lie in one share, so Spark's partial ``WindowGroupLimit`` keeps ``cap + 1``
of them before the shuffle, and the last window sees 64 * (cap + 1) narrow rows
of a source at most, however many the source has.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkline.session import scratch_path

SALT_BUCKETS = 64
LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
#: A table of one narrow row per source is broadcast up to so many rows; beyond, Spark joins by its own measure.
BROADCAST_ROWS = 100_000

Caps = Mapping[str, int] | int


@contextmanager
def group_limit(spark: SparkSession, n: int) -> Iterator[None]:
    """Let Spark apply its partial group limit up to ``n`` rows; the session's own setting comes back."""
    before = spark.conf.get(LIMIT_CONF)
    spark.conf.set(LIMIT_CONF, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(LIMIT_CONF, before)


def _small(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back; with a broadcast hint if it is measured as small."""
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def first_places(df: DataFrame, caps: Caps, media: str, order: str, tiebreak: str | None, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """source, k0, k1 and rank of the first rows of each capped source, one more than the largest cap."""
    keys = [order] + ([tiebreak] if tiebreak else [])
    rows = df.select(F.col(media).alias("source"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.pmod(F.spark_partition_id(), F.lit(salt_buckets)).alias("share"))
    most = caps
    if not isinstance(caps, int):
        rows, most = rows.filter(F.col("source").isin(*caps)), max(caps.values())
    for group in (["source", "share"], ["source"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*rows.columns[1:len(keys) + 1]))
        rows = rows.withColumn("rank", place).filter(F.col("rank") <= most + 1)
    return rows.drop("share")


def cut_offs(df: DataFrame, caps: Caps, media: str = "media", order: str = "crawl_seq", tiebreak: str | None = None, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Per source with as many rows as its cap or more: ``last`` (the place of its last kept row), how many rows of that place stay, and whether more have it.

    Runs as a job of its own; the result is a small table.
    """
    most = caps if isinstance(caps, int) else max(caps.values())
    with group_limit(df.sparkSession, most + 1):
        rows = first_places(df, caps, media, order, tiebreak, salt_buckets)
        keys, cap = rows.columns[1:-1], cap_column(caps, F.col("source"))
        ranks = rows.groupBy("source", *keys).agg(F.min("rank").alias("first"), F.max("rank").alias("final"))
        cuts = ranks.filter((F.col("first") <= cap) & (F.col("final") >= cap))
        return _small(cuts.select("source", F.struct(*keys).alias("last"), (cap - F.col("first") + 1).alias("allowed"), (F.col("final") > cap).alias("more")), "cuts")


def within(df: DataFrame, cuts: DataFrame, media: str = "media", order: str = "crawl_seq", tiebreak: str | None = None, exact: bool = True) -> DataFrame:
    """Rows of ``df`` up to their source's cut-off; sources without one keep every row.

    Rows that share the last place (the same order and tiebreak) are told apart only if more of them exist than stay; ``exact=False`` keeps them all.
    """
    place = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate([order] + ([tiebreak] if tiebreak else []))))
    named = cuts.select(F.col("source").alias("_source"), F.col("last").alias("_last"), F.col("allowed").alias("_allowed"), F.col("more").alias("_more"))
    out = df.join(named, df[media].eqNullSafe(named["_source"]), "left").filter(F.col("_last").isNull() | (place <= F.col("_last")))
    if not exact or cuts.filter("more").isEmpty():
        return out.select(*df.columns)
    at_last = F.coalesce(F.col("_more"), F.lit(False)) & place.eqNullSafe(F.col("_last"))
    nth = F.row_number().over(Window.partitionBy(media).orderBy(order))
    some = out.filter(at_last).withColumn("_nth", nth).filter("_nth <= _allowed")
    return out.filter(~at_last).select(*df.columns).unionByName(some.select(*df.columns))


def top_n(df: DataFrame, group: str, order: str, n: int, rank_col: str = "rn",
          salt_buckets: int = SALT_BUCKETS, tiebreak: str | None = None) -> DataFrame:
    """Rows ranked ``1..n`` within ``group`` by ``order`` (ties by ``tiebreak``); only they are shuffled."""
    if n <= 0:
        return df.limit(0).withColumn(rank_col, F.lit(None).cast("bigint"))
    kept = within(df, cut_offs(df, n, group, order, tiebreak, salt_buckets), group, order, tiebreak)
    return _with_rank(kept, group, order, rank_col, tiebreak)


def _with_rank(df: DataFrame, group: str, order: str, rank_col: str, tiebreak: str | None) -> DataFrame:
    w = Window.partitionBy(group).orderBy(order, *([tiebreak] if tiebreak else []))
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))


def cap_column(caps: Caps, media: Column) -> Column:
    """Per-source cap as a CASE expression (no join needed for a profile table)."""
    if isinstance(caps, int):
        return F.lit(caps)
    expr = None
    for m, c in caps.items():
        expr = (F.when(media == m, F.lit(c)) if expr is None else expr.when(media == m, F.lit(c)))
    return expr.otherwise(F.lit(None))


def cap_rows(df: DataFrame, caps: Caps, media: str = "media", order: str = "crawl_seq", tiebreak: str | None = None) -> DataFrame:
    """W1 without ranks: a filter where the rows are read; nothing of ``df`` is shuffled."""
    if not isinstance(caps, int):
        none = [m for m, n in caps.items() if n <= 0]
        caps = {m: n for m, n in caps.items() if n > 0}
        df = df.filter(~F.coalesce(F.col(media).isin(*none), F.lit(False))) if none else df
        if not caps:
            return df
    elif caps <= 0:
        return df.limit(0)
    return within(df, cut_offs(df, caps, media, order, tiebreak), media, order, tiebreak)


def source_cap(df: DataFrame, caps: Caps, media: str = "media",
               order: str = "crawl_seq", tiebreak: str | None = None) -> DataFrame:
    """The first ``cap`` rows of each source in crawl order, with their rank ``rn``.

    Sources without a cap keep every row (``rn`` NULL) and aren't shuffled.
    Applied to *parsed* rows, before the recency test (W4).
    """
    kept = cap_rows(df, caps, media, order, tiebreak)
    if isinstance(caps, int):
        return _with_rank(kept, media, order, "rn", tiebreak)
    capped = F.coalesce(F.col(media).isin(*caps), F.lit(False))
    return _with_rank(kept.filter(capped), media, order, "rn", tiebreak).unionByName(kept.filter(~capped).withColumn("rn", F.lit(None).cast("bigint")))


def prefix_stop(df: DataFrame, stale: Column, media: str = "media", order: str = "crawl_seq") -> DataFrame:
    """Keep rows before the first stale row of their source (then nothing more).

    A partial aggregate finds each source's first stale place; the rows are
    filtered by that table of one row per source.  Rows without a place come
    first, so they stay, unless one of them is stale.
    """
    marked = df.withColumn("_stale", F.coalesce(stale, F.lit(False)))
    at = F.struct(F.col(order).alias("o"))
    first = _small(marked.filter("_stale").groupBy(F.col(media).alias("_media")).agg(F.min(at).alias("_first")), "prefix")
    out = df.join(first, F.col(media).eqNullSafe(F.col("_media")), "left")
    return out.filter(F.col("_first").isNull() | (at < F.col("_first"))).drop("_media", "_first")


def twin_cap(df: DataFrame, response_cap: int, item_cap: int, is_item: Column,
             media: str = "media", order: str = "crawl_seq", tiebreak: str | None = None) -> DataFrame:
    """Stop at the first row where either count is exceeded.

    ``df`` holds every page received (listing pages included); a row is
    emitted when at most ``response_cap`` pages were received up to it and it
    is among the first ``item_cap`` items.  Both counts only grow, so the
    stop is the intersection of two cuts.
    """
    responses = top_n(df, media, order, response_cap, rank_col="response_no", tiebreak=tiebreak)
    items = responses.filter(is_item)
    return top_n(items, media, order, item_cap, rank_col="item_no", tiebreak=tiebreak)


def cap_then_recency(df: DataFrame, caps: Caps, fresh: Column,
                     media: str = "media", order: str = "crawl_seq", tiebreak: str | None = None) -> DataFrame:
    """The cap counts stale rows too; recency filters afterwards."""
    return cap_rows(df, caps, media, order, tiebreak).filter(fresh)


def source_counts(df: DataFrame, media: str = "media", status: str = "status") -> DataFrame:
    """Rows, parsed, filtered and rejected per source (partial aggregation)."""
    st = F.col(status)
    return df.groupBy(media).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((st == "parsed").cast("bigint")).alias("n_parsed"),
        F.sum((st == "filtered").cast("bigint")).alias("n_filtered"),
        F.sum((st == "rejected").cast("bigint")).alias("n_rejected"),
    )
