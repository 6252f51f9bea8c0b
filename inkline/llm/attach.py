"""Joining a table with one row a key to rows in which some key may be very frequent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than 1 / HEAVY of the rows are broadcast, so fewer than HEAVY rows ever are; one with LIGHT rows or fewer is no burden to any task.
HEAVY, LIGHT = 1000, 1000


def attach(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` with the other columns of ``table`` by ``keys`` (null equals null), null where the table has no such key.

    ``table`` has one row a key, its column ``weight`` (not attached) holds how many rows have the key.  Rows of a heavy key are settled where they are read; the rest, none with more than 1 / ``HEAVY`` of the rows, is shuffled.  Without a heavy key it is a plain join.  Both inputs may be read twice, so they should be written tables.
    """
    total, most = (x or 0 for x in table.agg(F.sum(weight), F.max(weight)).first())
    bound = max(total // HEAVY, LIGHT)
    named = table.select(*(F.col(k).alias(f"key_{k}") for k in keys), *(c for c in table.columns if c not in [*keys, weight]), F.col(weight).alias("key_rows"))
    on = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(named[f"key_{k}"]) for k in keys))
    added = [c for c in table.columns if c not in [*keys, weight]]
    if most <= bound:
        return rows.join(named, on, "left").select(*rows.columns, *added)
    is_heavy = F.col("key_rows") > F.lit(bound)
    heavy = F.broadcast(named.filter(is_heavy))
    here = rows.join(heavy, on, "inner").select(*rows.columns, *added)
    rest = rows.join(heavy, on, "left_anti")
    on_rest = reduce(lambda a, b: a & b, (rest[k].eqNullSafe(named[f"key_{k}"]) for k in keys))
    return here.unionByName(rest.join(named.filter(~is_heavy), on_rest, "left").select(*rows.columns, *added))
