"""Bit arrays of keys: where a key's bits are, for filters that tell most unseen keys without a look at the seen ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits set for each key.
HASHES = 4


def bit_places(key: Column, bits: int) -> list[Column]:
    """Places of a key's bits in an array of ``bits``; NULL is a key like any other."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def word_of(place: Column) -> Column:
    """The 64-bit word that holds a place."""
    return F.floor(place / 64)


def bit_of(place: Column) -> Column:
    """That word with the one bit set."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
