"""A portable row hash, the same in every SQL engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Two odd multipliers and the sizes of the hash's halves.
LOW_FACTOR, HIGH_FACTOR = 1640531527, 668265263
HALF, TOP = 4294967296, 1048576


def key_hash(df: DataFrame, key: str, seed: int = 0) -> Column:
    """0 .. 2^52 - 1, exact as a double, and different for different integer keys below 2^52.

    The halves of a 64-bit key are mixed one after the other. Keys that are not integers are hashed to 64 bits first.
    """
    column = F.col(key)
    number = column.cast("bigint") if df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long") else F.xxhash64(column)
    low, high = number.bitwiseAND(F.lit(HALF - 1)), F.shiftright(number, 32).bitwiseAND(F.lit(HALF - 1))
    mixed = (low * F.lit(LOW_FACTOR)) % F.lit(HALF)
    top = (((high + mixed + F.lit(seed)) % F.lit(HALF)) * F.lit(HIGH_FACTOR)) % F.lit(TOP)
    return top * F.lit(HALF) + mixed
