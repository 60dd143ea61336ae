"""Failures that concern one input and must not stop the others."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A reader may fail with an error that has no Python form of its own.
INPUT_ERRORS = (PySparkException, Py4JJavaError)


def failure(error: Exception) -> str:
    """Short status text for a run report."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return f"failed: {condition or type(error).__name__}"
