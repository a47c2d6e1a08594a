"""Keyed hashes for splits, folds and feature buckets.

The hash is the first 32 bits of an MD5 digest, so that a result does not depend on
the engine, the partitioning or the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def hash32(key: Column) -> Column:
    """A number in ``[0, 2**32)`` from the text of ``key``."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(term: Column, buckets: int) -> Column:
    return (hash32(term) % buckets).cast("int")
