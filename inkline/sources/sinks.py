"""Sinks (K1-K4): CSV per source, append to a table, idempotent append, JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkline.functions.bits import bit_of, bit_places, word_of
from inkline.session import scratch_path
from inkline.sources.tables import ARTICLE_COLUMNS

# --- fixed values -----------------------------------------------------------
CSV_COLUMNS = ("title", "subtitle", "body", "date", "media", "url", "comunas", "category_1", "pred_1",
               "category_2", "pred_2")
# --- end of fixed values ----------------------------------------------------

#: Folders that a table's keys are dealt into; a batch reads those of its own keys.
KEY_FOLDERS = 256
#: Bits of a key folder's array (32 KB), and batches after which the arrays' parts are combined.
FOLDER_BITS = 1 << 18
GENERATION = 32


def sink_projection(articles: DataFrame) -> DataFrame:
    """K2 column order (the table's insert list)."""
    return articles.select(*ARTICLE_COLUMNS)


def csv_projection(articles: DataFrame, key: str | None = None) -> DataFrame:
    """K1 columns, all text; ``pred_1``/``pred_2`` have no producer and stay empty.

    The CSV stage runs before categories are filled (K4), so the categories
    written are whatever the rows carry at that point.
    """
    date = F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")
    cols = {
        "date": date, "pred_1": F.lit(None).cast("string"), "pred_2": F.lit(None).cast("string"),
    }
    out = [cols[c].alias(c) if c in cols else F.col(c).cast("string").alias(c) for c in CSV_COLUMNS]
    return articles.select(*([F.col(key)] if key else []), *out)


def write_csv(articles: DataFrame, path: str) -> None:
    """K1 + K3: one folder per source, overwritten per run (only sources present).

    ``media`` stays a data column, so the partition column is a copy of it.
    Quotes are escaped by doubling and multi-line fields are quoted, so the
    files read back with ``multiLine``.  Rows of a source are gathered into
    files of AQE's partition size rather than one for each task.
    """
    df = csv_projection(articles).withColumn("source", F.col("media")).hint("rebalance", "source")
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("encoding", "UTF-8")
     .partitionBy("source").csv(path))


def read_csv(spark, path: str) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in CSV_COLUMNS) + ", source string"
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).schema(schema).csv(path))


def append_table(articles: DataFrame, path: str, partition_by: str | None = "media") -> None:
    """K2: append to a Parquet table (no key, a rerun duplicates, as in the reference)."""
    w = sink_projection(articles).write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def append_jdbc(articles: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """K2 through Spark's JDBC writer; connection details come from the caller."""
    sink_projection(articles).write.mode("append").jdbc(url, table, properties=properties or {})


def one_per_key(rows: DataFrame, key: str = "url") -> DataFrame:
    """One row of each key (NULL is a key too): the smallest by all columns, so a rerun keeps the same one."""
    first = F.min(F.struct(*(F.col(c) for c in rows.columns)))
    return rows.groupBy(F.col(key).alias("_key")).agg(first.alias("_row")).select("_row.*")


def new_rows(incoming: DataFrame, target: DataFrame, key: str = "url") -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``target`` (left anti join), one of each key."""
    return one_per_key(incoming.join(target.select(key).distinct(), key, "left_anti").select(incoming.columns), key)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder of data is there, asked of its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def key_folder(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(KEY_FOLDERS)).cast("int")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """The bit array of each key folder, as its words that aren't zero: key_folder, word, bits."""
    place = keys.select("key_folder", F.explode(F.array(*bit_places(F.col(key), FOLDER_BITS))).alias("p"))
    return place.groupBy("key_folder", word_of(F.col("p")).alias("word")).agg(F.bit_or(bit_of(F.col("p"))).alias("bits"))


class KeyFilter:
    """The bit arrays of a table's key folders, beside the table.

    Each batch adds its own words; after ``GENERATION`` batches they are combined
    into a new generation, so a reader never meets more than that.  A generation
    counts once it is complete.  A batch's bits are written before its rows: bits
    without rows cost a look into a folder, rows without bits would be missed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}_keys"
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _inside(self, path: str) -> list[str]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return [x.getPath().getName() for x in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def _generation(self) -> int | None:
        found = sorted((int(x.partition("=")[2]) for x in self._inside(self.path) if x.startswith("gen=")), reverse=True)
        return next((g for g in found if table_exists(self.spark, f"{self.path}/gen={g}/base/_SUCCESS")), None)

    def read(self) -> DataFrame | None:
        """Words of all batches; None where the table has no filter."""
        g = self._generation()
        if g is None:
            return None
        folders = [f"{self.path}/gen={g}/{x}" for x in self._inside(f"{self.path}/gen={g}")]
        words = self.spark.read.schema("key_folder int, word long, bits long").parquet(*(x for x in folders if table_exists(self.spark, f"{x}/_SUCCESS")))
        return words.groupBy("key_folder", "word").agg(F.bit_or("bits").alias("bits"))

    def add(self, words: DataFrame) -> None:
        g = self._generation()
        if g is None:
            words.write.parquet(f"{self.path}/gen=0/base")
            return
        words.write.parquet(f"{self.path}/gen={g}/{uuid.uuid4().hex}")
        if len(self._inside(f"{self.path}/gen={g}")) > GENERATION:
            self.read().write.mode("overwrite").parquet(f"{self.path}/gen={g + 1}/base")

    def may_hold(self, keys: DataFrame, key: str) -> DataFrame | None:
        """Rows (key, key_folder) whose bits are all set; None where nothing is known."""
        words = self.read()
        if words is None:
            return None
        places = keys.select(key, "key_folder", F.explode(F.array(*bit_places(F.col(key), FOLDER_BITS))).alias("p"))
        asked = places.select(key, "key_folder", word_of(F.col("p")).alias("word"), bit_of(F.col("p")).alias("bit")).distinct()
        found = asked.join(words, ["key_folder", "word"], "left")
        whole = F.min(F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False)))
        return found.groupBy(key, "key_folder").agg(whole.alias("all")).filter("all").drop("all")


def keys_in(spark: SparkSession, path: str, key: str, folders: list[int]) -> DataFrame:
    """The key column of some key folders of a table."""
    return spark.read.parquet(path).filter(F.col("key_folder").isin(folders)).select(key, "key_folder")


def append_new(rows: DataFrame, path: str, key: str = "url") -> DataFrame:
    """Append the rows whose key the table lacks, one of each key; returns them.

    The table is partitioned by a hash of the key, and beside it lies a bit
    array of each folder's keys.  Keys with a bit that isn't set are new without
    a look at the table; only the folders that may hold one of the others are
    read, and only those others are joined with them, exactly.
    """
    spark = rows.sparkSession
    batch = _written(one_per_key(rows, key).withColumn("key_folder", key_folder(key)), "batch")
    known = KeyFilter(spark, path)
    if table_exists(spark, path):
        maybe = known.may_hold(batch.select(key, "key_folder"), key)
        maybe = _written(batch.select(key, "key_folder") if maybe is None else maybe, "maybe")
        folders = [r[0] for r in maybe.select("key_folder").distinct().collect()]  # KEY_FOLDERS at most
        if folders:
            target = keys_in(spark, path, key, folders)
            same = maybe[key].eqNullSafe(target[key]) & (maybe["key_folder"] == target["key_folder"])
            there = _written(maybe.join(target, same, "left_semi"), "there")
            old = batch[key].eqNullSafe(there[key]) & (batch["key_folder"] == there["key_folder"])
            batch = _written(batch.join(there, old, "left_anti"), "new")
    known.add(key_bits(batch, key))
    batch.write.mode("append").partitionBy("key_folder").parquet(path)
    return batch.drop("key_folder")


def idempotent_append(articles: DataFrame, path: str, key: str = "url") -> None:
    """K2, idempotent: a rerun, or a row that comes twice, adds nothing."""
    append_new(sink_projection(articles), path, key)
