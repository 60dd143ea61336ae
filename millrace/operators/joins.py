"""Joins that stay splittable when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join `left`, whose keys may be hot, to `right` with one row per key.

    The adaptive skew split cuts a hot partition only where both sides come
    straight from a shuffle made for the join. `right` is usually an aggregate
    already partitioned by the keys, and then its shuffle is reused and nothing
    is split. A hash of the keys as one more join column asks for a shuffle of
    its own; it moves only the unique keys.
    """
    keys = list(keys)
    key_hash = F.xxhash64(*keys)
    return (
        left.withColumn("_key_hash", key_hash)
        .join(right.withColumn("_key_hash", key_hash), [*keys, "_key_hash"], how)
        .drop("_key_hash")
    )
