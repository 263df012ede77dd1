"""Ordered operators per key: moving bad ratio, failure streaks, rates, retries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import folds
from .blocks import fold_rows

# Smoothing, alert levels, retry limits and waits in seconds.
EMA_ALPHA = 0.05
WARN_AT = 0.90
STOP_AT = 0.99
MAX_ATTEMPTS = 5
MIN_WAIT, MAX_WAIT = 1, 20
RETRYABLE = ("rate_limited", "api_error")


def _levels(warn: float, stop: float) -> None:
    if not (0.0 < warn <= 1.0 and 0.0 < stop <= 1.0):
        raise ValueError("alert levels must be in (0, 1]")


def ema(
    outcomes: DataFrame,
    key: str,
    order: Iterable[str],
    is_bad: Column,
    alpha: float = EMA_ALPHA,
    blocks: int | None = None,
) -> DataFrame:
    """Exponential moving average of the bad ratio after each outcome (column ``ema``)."""
    x = F.when(is_bad, 1.0).otherwise(0.0)
    return fold_rows(outcomes, key, order, {"x": x}, folds.Ema(alpha), blocks)


def alert_level(average: Column, warn: float = WARN_AT, stop: float = STOP_AT) -> Column:
    _levels(warn, stop)
    return F.when(average >= stop, "stop").when(average >= warn, "warn")


def ema_with_resets(
    outcomes: DataFrame,
    key: str,
    order: Iterable[str],
    is_bad: Column,
    alpha: float = EMA_ALPHA,
    warn: float = WARN_AT,
    stop: float = STOP_AT,
    blocks: int | None = None,
) -> DataFrame:
    """Average and ``alert``; a stop alert that is answered "continue" resets the average."""
    _levels(warn, stop)
    x = F.when(is_bad, 1.0).otherwise(0.0)
    return fold_rows(outcomes, key, order, {"x": x}, folds.ResettingEma(alpha, warn, stop), blocks)


def failure_streaks(
    outcomes: DataFrame, key: str, order: Iterable[str], is_bad: Column, blocks: int | None = None
) -> DataFrame:
    """Bad outcomes in a row up to each outcome of a key (column ``streak``)."""
    bad = F.coalesce(is_bad, F.lit(False))
    return fold_rows(outcomes, key, order, {"bad": bad}, folds.Streak(), blocks)


def rate_excess(
    events: DataFrame, key: str, ts: str, limit: int, interval: str = "1 second"
) -> DataFrame:
    """Intervals in which a key had more than ``limit`` events, and by how many; events without a time don't count."""
    window = F.window(ts, interval)
    return (
        events.filter(F.col(ts).isNotNull())
        .groupBy(key, window["start"].alias("window_start"))
        .agg(F.count("*").alias("events"))
        .filter(F.col("events") > limit)
        .withColumn("excess", F.col("events") - limit)
    )


def resolve_attempts(
    attempts: DataFrame,
    key: str,
    order: Iterable[str],
    error_class: Column,
    max_attempts: int = MAX_ATTEMPTS,
    retryable: Iterable[str] = RETRYABLE,
) -> DataFrame:
    """Outcome of each ticket's retries.

    Only retryable errors are tried again, at most ``max_attempts`` times: the
    first other outcome decides, else the last attempt's error. ``error_class``
    is null for a success. Later attempts of the log are ignored. The rank
    limit is applied before the shuffle, so a key moves a handful of rows.
    """
    ranked = Window.partitionBy(key).orderBy(*order)
    first = (
        attempts.select(key, *order, error_class.alias("error_class"))
        .withColumn("attempt", F.row_number().over(ranked))
        .filter(F.col("attempt") <= max_attempts)
    )
    final = F.coalesce(~F.col("error_class").isin(*retryable), F.lit(True))
    outcome = F.struct("attempt", "error_class")
    decided = first.groupBy(key).agg(
        F.min(F.when(final, outcome)).alias("decided"), F.max(outcome).alias("last")
    )
    chosen = F.coalesce("decided", "last")
    waits = F.transform(
        F.sequence(F.lit(1), F.col("attempts")),
        lambda n: F.when(
            n < F.col("attempts"), F.least(F.lit(MAX_WAIT), F.greatest(F.lit(MIN_WAIT), F.pow(F.lit(2), n - 1)))
        ).otherwise(0.0),
    )
    return (
        decided.select(key, chosen.alias("x"))
        .select(
            key,
            F.col("x.attempt").alias("attempts"),
            F.when(F.col("x.error_class").isNull(), "success").otherwise("error").alias("status"),
            F.col("x.error_class").alias("error_class"),
        )
        .withColumn("waited_seconds", F.aggregate(waits, F.lit(0.0), lambda a, w: a + w))
    )
