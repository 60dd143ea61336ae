"""Key/value attributes as columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_attributes(
    attributes: DataFrame,
    owner: str,
    key: str,
    value: str,
    names: Mapping[str, str],
    pick: Callable[[Column], Column] = F.max,
) -> DataFrame:
    """One row per owner with a column per listed key: `{key value: column name}`.

    One aggregation, combined before its only shuffle. `pick` settles several
    values of one key; to keep them all as rows, join one lookup per key instead.
    """
    columns = [
        pick(F.when(F.col(key) == wanted, F.col(value))).alias(name) for wanted, name in names.items()
    ]
    return attributes.groupBy(owner).agg(*columns)
