"""Random draws that depend on the row key only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(key: Column, salt: object) -> Column:
    """32 hex digits from the row key and a salt."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{salt}")))


def uniform(key: Column, salt: object) -> Column:
    """Uniform draw in [0, 1) from the first 32 bits of the hash."""
    bits = F.conv(F.substring(row_hash(key, salt), 1, 8), 16, 10).cast("double")
    return bits / F.lit(4294967296.0)


def bernoulli(key: Column, salt: object, rate: Column) -> Column:
    return (uniform(key, salt) < rate).cast("int")


def integer_below(key: Column, salt: object, bound: Column) -> Column:
    return F.floor(uniform(key, salt) * bound).cast("int")
