"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

1. One scan reduces each text to its SHA-256; the narrow table of row number,
   id and digest is written to the shared scratch folder.
2. A frequent-items sketch (Misra-Gries counters) over the digests finds
   candidates.  A count may be short by rows / (0.75 * ``COUNTERS``), so every
   digest with more than 1 / ``HEAVY`` of the rows beyond that (1 / 768 in all)
   is among them, and lighter ones may be.  Sketches are merged in two levels,
   so no task merges all of them.
3. The candidates' exact counts and kept rows are computed with map-side
   combining; those winners (at most ``HEAVY`` rows, about 100 bytes each)
   are broadcast, and their rows are settled where they are read.
4. The remaining digests, none of them with more than 1 / 768 of the rows, go
   through one ordinary shuffle on the digest.  The result is exact whatever
   the sketch finds.

Texts are equal when their UTF-8 bytes are; null counts as empty.  Of equal
texts the row with the largest id stays; of rows with equal text and equal
id, one of them (they are copies).  Null ids are smaller than all others.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkline.llm.scratch import written

#: Winners at most, and so the size bound of what is broadcast.
HEAVY = 1024
#: Counters of a sketch; it sees every item above rows / (0.75 * COUNTERS).
COUNTERS = 4096
#: Groups that merge sketches before the last merge.
SKETCH_GROUPS = 64


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id and digest of each document, written once."""
    d = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))
    return written(d.select(F.monotonically_increasing_id().alias("row"), "id", "digest"), "digests")


def heavy_hitters(d: DataFrame) -> DataFrame:
    """Per frequent digest: its exact number of rows and the row that stays."""
    name = F.hex("digest").alias("item")
    parts = d.select((F.spark_partition_id() % SKETCH_GROUPS).alias("part"), name).groupBy("part").agg(F.expr(f"approx_top_k_accumulate(item, {COUNTERS})").alias("sketch"))
    top = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {COUNTERS}), {HEAVY})").alias("top"))
    items = top.select(F.explode("top").alias("t")).filter("t.count > 1").select(F.unhex("t.item").alias("digest"))
    exact = d.join(F.broadcast(items), "digest").groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("keep"))
    return exact.filter("group_size > 1")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    d = digests(docs, id_col, text_col)
    heavy = written(heavy_hitters(d), "heavy")
    marked = d.join(F.broadcast(heavy), "digest", "left")
    here = marked.filter("group_size IS NOT NULL")
    same = Window.partitionBy("digest")
    rest = marked.filter("group_size IS NULL").select("digest", "row", "id").select("digest", "row", "id", F.count(F.lit(1)).over(same).alias("group_size"), F.max(F.struct("id", "row")).over(same).alias("keep"))
    both = here.select(rest.columns).unionByName(rest)
    return both.select(F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; the text travels once, and only where it can still have a copy elsewhere."""
    heavy = written(heavy_hitters(digests(docs, id_col, text_col)), "heavy").select("digest", F.col("keep.id").alias("keep_id"), F.lit(True).alias("is_heavy"))
    own = docs.columns
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("doc"), F.col(id_col).alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))
    open_ = named.join(F.broadcast(heavy), "digest", "left").filter(F.col("is_heavy").isNull() | F.col("id").eqNullSafe(F.col("keep_id")))
    first = F.row_number().over(Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last()))
    return open_.withColumn("place", first).filter("place = 1").select(*(F.col("doc").getField(c).alias(c) for c in own))
