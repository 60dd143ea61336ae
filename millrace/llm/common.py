"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import tune

# Rows per Arrow batch: a batch of whole documents must stay small beside a task's memory.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the corpus operators on a session somebody else built."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


_SHARED: dict[tuple, Broadcast] = {}


def shared(spark: SparkSession, key: tuple, make: Callable[[], object]) -> Broadcast:
    """The broadcast of a value that is the same in every query, such as a vocabulary; one per application.

    Python workers are used again and keep each broadcast they have met, with what its object remembers.
    """
    app = spark.sparkContext.applicationId
    for old in [k for k in _SHARED if k[0] != app]:
        del _SHARED[old]
    if (app, *key) not in _SHARED:
        _SHARED[(app, *key)] = spark.sparkContext.broadcast(make())
    return _SHARED[(app, *key)]


def free_name(df: DataFrame, label: str) -> str:
    """A column name that `df` does not have, so that added columns clash with none."""
    taken = {c.lower() for c in df.columns}
    name = label
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_key(text: Column) -> tuple[Column, Column]:
    """Two hashes that name a text: equal texts have equal keys, others differ."""
    return F.xxhash64(text), F.xxhash64(F.lit("millrace"), text)


def text_chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive rows of a batch, cut where their UTF-8 bytes pass `limit`.

    A single longer text is a chunk of its own. Yields the first row's number and the texts.
    """
    texts = column.to_pylist()
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > limit:
            yield start, texts[start:i]
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, texts[start:]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the public SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
