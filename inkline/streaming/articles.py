"""Structured Streaming: the same Column expressions over a page stream.

* R1 ``article_stream`` - stateless extraction + enrichment, identical Columns
  to the batch plan.
* R2 ``dedup_stream`` - ``dropDuplicatesWithinWatermark`` on the canonical
  URL; the watermark column ``fetched_at`` must be a ``TIMESTAMP`` (a
  watermark on ``TIMESTAMP_NTZ`` fails analysis), the session time zone is
  UTC so it compares with the wall-clock dates.
* R3 ``idempotent_sink`` - ``foreachBatch`` + anti-join on the key before the
  append, so a replayed micro-batch writes nothing twice.
* R4 ``fresh_at_fetch`` - recency against the event column ``fetched_at``
  (replayable) rather than the wall clock.
* R5 ``capped_stream`` - W1 caps and W2 prefix stop across micro-batches, with
  each source's count and stop in the state store; ``capped_sink`` does the same
  in ``foreachBatch`` with the batch operators.
  Exact if each source's pages arrive in crawl order across batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from inkline.functions import text as TX
from inkline.functions import urls as U
from inkline.operators import limits as L
from inkline.operators.profiles import Profile, parsed
from inkline.plans.articles import enrich
from inkline.session import scratch_path
from inkline.sources.sinks import append_new, table_exists

FETCH_WATERMARK = "2 days"   # the 48 h freshness bound of P5


def read_page_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """R1 source: Parquet files of pages arriving in the folder ``path``, or the one file ``path``."""
    r = spark.readStream.schema(schema)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        r, path = r.option("pathGlobFilter", at.getName()), at.getParent().toString()
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def article_stream(pages: DataFrame, profile: Profile, places: Sequence[str] = (),
                   stopwords: Sequence[str] = TX.DEFAULT_STOPWORDS,
                   phrases: Sequence[str] = TX.GORE_PHRASES) -> DataFrame:
    """Parsed pages -> enriched article rows (no cap, no window)."""
    out = enrich(parsed(pages, profile), places, stopwords, phrases)
    return out.withColumn("category_1", F.lit("")).withColumn("category_2", F.lit(""))


def dedup_stream(pages: DataFrame, fetched_at: str = "fetched_at", url: str = "url") -> DataFrame:
    """R2: one row per canonical URL within the watermark."""
    return (pages.withColumn("canon_url", U.canonical(F.col(url)))
            .withWatermark(fetched_at, FETCH_WATERMARK)
            .dropDuplicatesWithinWatermark(["canon_url"]))


def fresh_at_fetch(df: DataFrame, published: str = "published_at", fetched_at: str = "fetched_at") -> DataFrame:
    """Kept iff younger than 48 h when it was fetched (future kept)."""
    fetched_wall = F.col(fetched_at).cast("timestamp_ntz")
    return df.filter(F.col(published) > F.timestamp_add("HOUR", F.lit(-48), fetched_wall))


def idempotent_sink(path: str, key: str = "url"):
    """A ``foreachBatch`` function appending only keys the target lacks, one row of each."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        append_new(batch, path, key)

    return write


def capped_stream(rows: DataFrame, caps: dict[str, int], stale: Column | None = None, stop: Sequence[str] = (),
                  media: str = "media", order: str = "crawl_seq") -> DataFrame:
    """The rows of a stream that caps (W1) and prefix stops (W2) let through, over all of its batches.

    At most ``caps[media]`` rows of a source pass; a source in ``stop`` ends for
    good with its first ``stale`` row; other sources aren't touched and pass no
    shuffle.  How many rows of a source have passed and whether it has stopped is
    the state of its key in the state store, so a batch costs its own rows
    however many came before, and a restart goes on from the checkpoint.

    Each task first cuts its share of a source to what could pass at most (the
    first ``cap`` rows, up to a stale one), so the task that holds a source's state
    gets a bounded number of rows from each of the others, and keeps ``cap`` of
    them.  For a source that stops but has no cap that bound is the batch's own
    rows before the stale one.
    """
    columns = rows.columns
    limited = F.coalesce(F.col(media).isin(*{*caps, *stop}), F.lit(False))
    marked = rows.withColumn("_stale", F.coalesce(stale, F.lit(False)) & F.col(media).isin(*stop) if stale is not None and stop else F.lit(False))

    def first(held: pd.DataFrame | None, part: pd.DataFrame, most: int | None) -> pd.DataFrame:
        """The first rows in order, ``most`` of them and up to a stale one."""
        both = part if held is None else pd.concat([held, part])
        both = both.sort_values(order, kind="stable", na_position="first", ignore_index=True)
        both = both if most is None else both.head(most)
        old = both.index[both["_stale"].astype(bool)]
        return both if not len(old) else both.head(old[0] + 1)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, pd.DataFrame] = {}
        for part in parts:
            for source, own in part.groupby(media):
                held[source] = first(held.get(source), own, caps.get(source))
        yield from held.values()

    def advance(key: tuple[str], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, stopped = state.get if state.exists else (0, False)
        cap, held = caps.get(key[0]), None
        left = None if cap is None else max(0, cap - done)
        for part in parts:
            if not stopped and left != 0:
                held = first(held, part, left)
        if held is None:
            return
        fresh = held[~held["_stale"].astype(bool)]
        state.update((done + len(fresh), len(fresh) < len(held)))
        yield fresh[columns]

    narrowed = marked.filter(limited).mapInPandas(cut, marked.schema)
    passed = narrowed.groupBy(media).applyInPandasWithState(advance, rows.schema, "done LONG, stopped BOOLEAN", "append", GroupStateTimeout.NoTimeout)
    return rows.filter(~limited).unionByName(passed)


def capped_sink(path: str, caps: dict[str, int], stale: Column | None = None, stop: Sequence[str] = (),
                media: str = "media", order: str = "crawl_seq"):
    """A ``foreachBatch`` function with W1 and W2 over the whole stream.

    At most ``caps[media]`` rows of a source are appended over all batches; a
    source without a cap keeps every row, as in batch; a source in ``stop``
    ends for good with its first ``stale`` row.  How far each source has come
    is a small table beside the output (one row per source), written anew by
    each batch from the one before and keyed by the batch, so a batch that runs
    again reads the same state and gives the same rows.  Ranks use
    :func:`~inkline.operators.limits.source_cap`, which finds the cut on narrow
    rows.  Exact if a source's pages arrive in crawl order across batches.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        state_path = f"{path.rstrip('/')}_progress"
        before = f"{state_path}/batch={epoch_id - 1}"
        state = spark.read.parquet(before) if table_exists(spark, before) else spark.createDataFrame([], PROGRESS)
        state = state.select(F.col("media").alias("_m"), F.col("emitted").alias("_done"), F.col("stopped").alias("_stopped"))
        marked = batch.withColumn("_stale", F.coalesce(stale, F.lit(False)) & F.col(media).isin(*stop) if stop else F.lit(False))
        rows = L.source_cap(marked, caps, media, order).join(state, F.col(media).eqNullSafe(F.col("_m")), "left")
        left = F.coalesce(L.cap_column(caps, F.col(media)) - F.coalesce("_done", F.lit(0)), F.lit(1 << 62)) if caps else F.lit(1 << 62)
        rows = rows.filter(~F.coalesce("_stopped", F.lit(False)) & (F.col("rn").isNull() | (F.col("rn") <= left))).drop("_m", "_done", "_stopped")
        scratch = scratch_path(spark, f"capped/{uuid.uuid4().hex}")
        rows.write.parquet(scratch)  # narrow work once: counts and rows come from the same table
        rows = spark.read.schema(rows.schema).parquet(scratch)
        first = rows.filter("_stale").groupBy(F.col(media).alias("_m")).agg(F.min(order).alias("_first"))
        marked = rows.join(first, F.col(media).eqNullSafe(F.col("_m")), "left").withColumn("_keep", F.col("_first").isNull() | (F.col(order) < F.col("_first")))
        now = marked.groupBy(F.col(media).alias("media")).agg(F.count(F.when(F.col("_keep"), 1)).alias("emitted"), F.max("_stale").alias("stopped"))
        total = now.unionByName(state.toDF("media", "emitted", "stopped")).groupBy("media").agg(F.sum("emitted").alias("emitted"), F.max("stopped").alias("stopped"))
        total.write.mode("overwrite").parquet(f"{state_path}/batch={epoch_id}")
        marked.filter("_keep").select(batch.columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch_id}")

    return write


PROGRESS = "media string, emitted long, stopped boolean"


def run_sink(df: DataFrame, sink, name: str | None = None) -> None:
    """Run a stream with ``availableNow`` through a ``foreachBatch`` function."""
    chk = scratch_path(df.sparkSession, f"streams/{name or uuid.uuid4().hex}/checkpoint")
    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", chk).trigger(availableNow=True).start()
    q.awaitTermination()


def run_available(df: DataFrame, name: str | None = None, fmt: str = "parquet") -> str:
    """Run a stream with ``availableNow`` into a fresh folder of the shared
    checkpoint area; returns the output path (read it back in batch)."""
    spark = df.sparkSession
    run = name or uuid.uuid4().hex
    out = scratch_path(spark, f"streams/{run}/out")
    chk = scratch_path(spark, f"streams/{run}/checkpoint")
    q = (df.writeStream.format(fmt).option("path", out).option("checkpointLocation", chk)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return out
