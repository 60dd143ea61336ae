"""Hook for row logic that no built-in function expresses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def transform_batches(
    df: DataFrame, transform: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply a pandas function to Arrow batches of rows.

    A batch is a bounded part of a partition
    (`spark.sql.execution.arrow.maxRecordsPerBatch`), never a whole group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(transform, batches)

    return df.mapInPandas(run, schema)
