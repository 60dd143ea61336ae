"""Student t quantile for the regression guardrail.

Spark has no inverse t. The quantile is needed once per series, after the
aggregation, so a vectorised UDF over the degrees of freedom is cheap: each
batch solves only its distinct values.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _two_sided_mass(t: float, dof: int) -> float:
    """P(|T| < t) for whole degrees of freedom, by the finite cosine series
    (Abramowitz and Stegun 26.7.3 and 26.7.4)."""
    theta = math.atan2(t, math.sqrt(dof))
    sin, cos = math.sin(theta), math.cos(theta)
    cos2 = cos * cos
    odd = dof % 2
    term = cos if odd else 1.0
    total = term if dof > 1 else 0.0
    for k in range(3 if odd else 2, dof - 1, 2):
        term *= cos2 * (k - 1) / k
        total += term
    return (2 / math.pi) * (theta + sin * total) if odd else sin * total


def t_quantile(dof: int, confidence: float = 0.95) -> float:
    """Two-sided quantile: P(|T| < result) = confidence."""
    if dof < 1:
        return math.nan
    low, high = 0.0, 2.0
    while _two_sided_mass(high, dof) < confidence:
        low, high = high, high * 2
    while True:
        middle = (low + high) / 2
        if middle in (low, high):
            return middle
        if _two_sided_mass(middle, dof) < confidence:
            low = middle
        else:
            high = middle


def t_quantile_column(dof: Column, confidence: float = 0.95) -> Column:
    @F.pandas_udf("double")
    def solve(values: pd.Series) -> pd.Series:
        known = {d: t_quantile(int(d), confidence) for d in values.dropna().unique()}
        return values.map(known)

    return solve(dof)
