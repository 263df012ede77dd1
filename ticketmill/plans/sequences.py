"""Registered sequence queries: moving averages, failure streaks, rates, retries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor, sequence
from ..settings import Settings
from .monitoring import IS_BAD, is_bad
from .tables import table

ORDER = ["ts", "event_id"]
# Levels and limits at which this sparse log shows every state.
WARN, STOP = 0.15, 0.25
RATE_LIMIT = 1  # per key and 12 hours
RETRIES = f"CASE WHEN {IS_BAD} THEN 'api_error' WHEN event_type = 'view' THEN 'rate_limited' " \
    "WHEN event_type = 'signup' THEN 'schema_error' END"


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")


def bad_ratio_ema(spark: SparkSession, folder: str, settings: Settings = Settings()) -> DataFrame:
    averaged = sequence.ema(outcomes(spark, folder), "user_id", ORDER, is_bad(), settings.ema_alpha)
    return averaged.select("user_id", "event_id", F.round("ema", 10).alias("ema"))


def progress_ema(spark: SparkSession, folder: str) -> DataFrame:
    """One average over the whole log: a single key that holds every row."""
    log = outcomes(spark, folder).withColumn("run", F.lit(0))
    averaged = sequence.ema(log, "run", ORDER, is_bad())
    rows = monitor.progress(averaged, "ts", is_bad(), "30 seconds", ("ema", "event_id"))
    return rows.withColumn("ema", F.round("ema", 10))


def ema_alerts(spark: SparkSession, folder: str) -> DataFrame:
    averaged = sequence.ema(outcomes(spark, folder), "user_id", ORDER, is_bad())
    level = sequence.alert_level(F.round("ema", 10), WARN, STOP)
    return averaged.select("user_id", "event_id", level.alias("alert")).filter("alert IS NOT NULL")


def ema_resets(spark: SparkSession, folder: str) -> DataFrame:
    averaged = sequence.ema_with_resets(
        outcomes(spark, folder), "user_id", ORDER, is_bad(), warn=WARN, stop=STOP
    )
    return averaged.select("user_id", "event_id", F.round("ema", 10).alias("ema"), "alert")


def failure_streaks(spark: SparkSession, folder: str) -> DataFrame:
    log = sequence.failure_streaks(outcomes(spark, folder), "user_id", ORDER, is_bad())
    return log.select("user_id", "event_id", "streak")


def rate_excess(spark: SparkSession, folder: str) -> DataFrame:
    return sequence.rate_excess(outcomes(spark, folder), "user_id", "ts", RATE_LIMIT, "12 hours")


def attempt_outcomes(spark: SparkSession, folder: str, settings: Settings = Settings()) -> DataFrame:
    log = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return sequence.resolve_attempts(log, "user_id", ORDER, F.expr(RETRIES), settings.max_attempts).select(
        "user_id", F.col("attempts").cast("bigint").alias("attempts"), "status", "error_class", "waited_seconds"
    )


QUERIES = {
    f.__name__: f
    for f in (bad_ratio_ema, progress_ema, ema_alerts, ema_resets, failure_streaks, rate_excess, attempt_outcomes)
}

_LOG = f"""log AS (SELECT user_id, event_id, epoch_us(ts) AS us, {IS_BAD} AS bad, row_number() OVER
    (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)"""
EMA_SQL = f"""WITH RECURSIVE {_LOG}, walk AS (
    SELECT user_id, event_id, n, 0.05::DOUBLE * bad::INT AS ema FROM log WHERE n = 1
    UNION ALL SELECT l.user_id, l.event_id, l.n, 0.05::DOUBLE * l.bad::INT + 0.95::DOUBLE * w.ema
    FROM walk w JOIN log l ON l.user_id = w.user_id AND l.n = w.n + 1)"""
_RESET = f"""WITH RECURSIVE {_LOG}, walk AS (
    SELECT user_id, event_id, n, 0.05::DOUBLE * bad::INT AS ema FROM log WHERE n = 1
    UNION ALL SELECT l.user_id, l.event_id, l.n, 0.05::DOUBLE * l.bad::INT
        + 0.95::DOUBLE * CASE WHEN w.ema >= {STOP} THEN 0 ELSE w.ema END
    FROM walk w JOIN log l ON l.user_id = w.user_id AND l.n = w.n + 1)"""
_STREAKS = f"""WITH {_LOG} SELECT user_id, event_id, n - coalesce(max(n) FILTER (WHERE NOT bad)
    OVER (PARTITION BY user_id ORDER BY n), 0) AS streak FROM log"""

# 0.95^1000 is below 1e-22, so older outcomes leave no trace in ten places.
_GLOBAL = f"""WITH numbered AS (SELECT ts, event_id, {IS_BAD} AS bad, row_number() OVER (ORDER BY ts, event_id) AS n
    FROM events), averaged AS (SELECT a.ts, a.event_id, a.bad,
        sum(0.05::DOUBLE * b.bad::INT * pow(0.95::DOUBLE, a.n - b.n)) AS ema
        FROM numbered a JOIN (SELECT *, unnest(range(n, n + 1000)) AS m FROM numbered) b ON b.m = a.n GROUP BY ALL)"""

ORACLES = {
    "progress_ema": f"""{_GLOBAL} SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, count(*) AS processed,
        count(*) FILTER (WHERE NOT bad) AS good, count(*) FILTER (WHERE bad) AS bad,
        round(arg_max(ema, (ts, event_id)), 10) AS ema FROM averaged GROUP BY 1""",
    "bad_ratio_ema": f"{EMA_SQL} SELECT user_id, event_id, round(ema, 10) AS ema FROM walk",
    "ema_alerts": f"""{EMA_SQL} SELECT user_id, event_id, CASE WHEN round(ema, 10) >= {STOP} THEN 'stop' ELSE 'warn' END
        AS alert FROM walk WHERE round(ema, 10) >= {WARN}""",
    "ema_resets": f"""{_RESET} SELECT user_id, event_id, round(ema, 10) AS ema,
        CASE WHEN ema >= {STOP} THEN 'stop' WHEN ema >= {WARN} THEN 'warn' END AS alert FROM walk""",
    "failure_streaks": _STREAKS,
    "rate_excess": f"""SELECT user_id, time_bucket(INTERVAL 12 HOUR, ts) AS window_start, count(*) AS events,
        count(*) - {RATE_LIMIT} AS excess FROM events GROUP BY ALL HAVING count(*) > {RATE_LIMIT}""",
    "attempt_outcomes": f"""WITH ranked AS (SELECT user_id, {RETRIES} AS error_class, row_number() OVER
        (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
        ends AS (SELECT user_id, coalesce(min(n) FILTER (WHERE n <= 5 AND (error_class IS NULL
            OR error_class NOT IN ('rate_limited', 'api_error'))), least(5, max(n))) AS attempts
            FROM ranked GROUP BY user_id)
        SELECT e.user_id, e.attempts, CASE WHEN r.error_class IS NULL THEN 'success' ELSE 'error' END AS status,
        r.error_class, CAST(coalesce(list_sum(list_transform(range(1, e.attempts),
            lambda i: least(20, pow(2, i - 1)))), 0) AS DOUBLE) AS waited_seconds
        FROM ends e JOIN ranked r ON r.user_id = e.user_id AND r.n = e.attempts""",
}
