"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from inkline.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not what came before.  The folder is unique to the call, so nothing is overwritten; it is scratch, to be dropped with the checkpoint folder.
    """
    path = f"{scratch_path(df.sparkSession, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
