"""Seeded draws. A hash of a stable id, never rand(): a retried task must draw the same value again."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_BITS = 60


def _hash_bits(seed, *ids: Column, digits: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids])
    # Never null, and said so: else every join on it would compute it once more for a null check.
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint"), F.lit(0))


def uniform32(seed, *ids: Column) -> Column:
    """Uniform integer in [0, 2**32)."""
    return _hash_bits(seed, *ids, digits=8)


def order_hash(seed, *ids: Column) -> Column:
    """Uniform integer in [0, 2**60), used as a shuffle order."""
    return _hash_bits(seed, *ids, digits=ORDER_BITS // 4)
