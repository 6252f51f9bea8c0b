"""Connected components of an edge table, by large-star and small-star rounds.

Each round points nodes at the smallest node they can see; rounds end when the
edges no longer change (about the logarithm of a component's diameter).  Rounds
are written to the shared scratch folder; minima are combined map-side and
joined back with heavy nodes broadcast, so a node with very many edges is never
gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.llm.attach import attach
from inkline.llm.scratch import written


def _least(e: DataFrame) -> DataFrame:
    """The smallest ``v`` of each ``u``, and the number of its edges."""
    return written(e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("u", "m"))
    return attach(both.filter("v > u"), least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = attach(down, least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of ``edges`` (u, v: long, u <> v)."""
    state, e = None, written(edges.select("u", "v"), "edges")
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        e = written(_small_star(_large_star(e)), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
