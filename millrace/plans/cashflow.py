"""Cash-flow series: roll-forward, regression guardrail, balances per period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.stats import t_quantile_column

_BEFORE = (W.unboundedPreceding, -1)


def daily_series(movements: DataFrame, series: str, day: Column, credit: Column, debit: Column) -> DataFrame:
    """One row per series and day. Movements combine before the shuffle.

    From here on a series has at most one row per calendar day, which bounds
    every window below however many movements one series holds.
    """
    return movements.groupBy(F.col(series).alias("series_id"), day.alias("date")).agg(
        F.sum(credit).alias("credits"), F.sum(debit).alias("debits")
    )


def opening_balances(
    daily: DataFrame, opening: Column, credits: str = "credits", debits: str = "debits"
) -> DataFrame:
    """Balance before each day's movement; the first day has the opening balance."""
    earlier = W.partitionBy("series_id").orderBy("date").rowsBetween(*_BEFORE)
    moved = F.sum(F.col(credits) - F.col(debits)).over(earlier)
    return daily.withColumn("balance", opening + F.coalesce(moved, F.lit(0)))


def guardrail(history: DataFrame, projection: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Is the projected balance outside the prediction band of the past balances?

    A line is fitted to the balance over the day number; the band is the
    prediction interval at the last projected day. The projected balance rolls
    the last known balance forward over the projected movements. A series too
    short for a band counts as outside.
    """
    by_day = W.partitionBy("series_id").orderBy("date")
    numbered = history.withColumn("x", F.row_number().over(by_day).cast("double"))
    y, x = F.col("balance"), F.col("x")
    fit = numbered.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean_x"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.max_by(y + F.col("credits") - F.col("debits"), "date").alias("opening"),
    )
    moved = F.col("credits_prediction") - F.col("debits_prediction")
    ahead = projection.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("steps"),
        (F.sum(moved) - F.max_by(moved, "date")).alias("moved"),
    )
    n, dof = F.col("n"), F.col("n") - 2
    x_last = n + F.col("steps")
    # Null below three days; the guard also keeps ANSI division from failing.
    has_band = dof > 0
    sse = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
    leverage = 1 + 1 / n + F.pow(x_last - F.col("mean_x"), F.lit(2)) / F.col("sxx")
    spread = F.when(has_band, F.col("t") * F.sqrt(sse / dof * leverage))
    expected = F.col("intercept") + F.col("slope") * x_last
    inside = F.col("projected").between(F.col("lower"), F.col("upper"))
    return (
        fit.join(ahead, "series_id")
        .withColumn("t", t_quantile_column(dof, confidence))
        .withColumn("lower", expected - spread)
        .withColumn("upper", expected + spread)
        .withColumn("projected", F.col("opening") + F.col("moved"))
        .select("series_id", "n", "lower", "projected", "upper", (~F.coalesce(inside, F.lit(False))).alias("outside"))
    )


def closing_balances(daily: DataFrame, opening: Column) -> DataFrame:
    """Balance after each day with movements."""
    opened = opening_balances(daily, opening)
    return opened.select(
        "series_id", "date", (F.col("balance") + F.col("credits") - F.col("debits")).alias("balance")
    )


def period_balances(closing: DataFrame, period: str) -> DataFrame:
    """Last balance of each week or month, and the change since the one before."""
    start = F.date_trunc(period, "date").cast("date")
    last = closing.groupBy("series_id", start.alias("period_start")).agg(
        F.max_by("balance", "date").alias("balance")
    )
    previous = F.lag("balance").over(W.partitionBy("series_id").orderBy("period_start"))
    return last.withColumn("change", F.col("balance") - previous)
