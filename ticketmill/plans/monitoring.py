"""Registered monitoring queries over the event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor
from .tables import table

IS_BAD = "event_type = 'error'"
# The log has no error classes: value ranges stand in for them.
CLASS = "CASE WHEN value < 10 THEN 'api_error' WHEN value < 20 THEN 'timeout' ELSE 'too_short' END"
# Answers of a reviewer, good and bad ones.
ANSWER = """CASE event_type WHEN 'error' THEN '{"decision":"STOP","explanation":"fault"}'
    WHEN 'click' THEN '{"decision":"Continue"}' WHEN 'view' THEN 'continue' WHEN 'signup' THEN '{"explanation":"?"}'
    ELSE concat('{"decision":', event_id, '}') END"""


def is_bad() -> Column:
    return F.expr(IS_BAD)


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.run_summary(outcomes(spark, folder), is_bad(), ["user_id"])


def progress_30s(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.with_totals(monitor.progress(outcomes(spark, folder), "ts", is_bad()))


def throughput(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.throughput(outcomes(spark, folder), "ts", ["user_id"])


def _recent(spark: SparkSession, folder: str) -> DataFrame:
    rows = outcomes(spark, folder).select("user_id", "ts", "event_id", "event_type", "value", "props")
    return monitor.recent_bad(rows, is_bad(), "user_id", ["ts", "event_id"])


def recent_bad(spark: SparkSession, folder: str) -> DataFrame:
    return _recent(spark, folder).select("user_id", "event_id", F.col("age").cast("bigint").alias("age"))


def bad_digest(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.digest(_recent(spark, folder), "user_id", F.col("props"), F.expr(CLASS))


def health_decision(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "events").select("user_id")
    return monitor.health(keys, _recent(spark, folder), "user_id", F.expr(CLASS))


def review_decisions(spark: SparkSession, folder: str) -> DataFrame:
    answers = table(spark, folder, "events").selectExpr("event_id", f"{ANSWER} AS answer")
    return answers.select("event_id", monitor.decision_of(F.col("answer")).alias("decision"))


QUERIES = {
    f.__name__: f
    for f in (run_summary, progress_30s, throughput, recent_bad, bad_digest, health_decision, review_decisions)
}

PROGRESS_SQL = f"""SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, count(*) AS processed,
    count(*) FILTER (WHERE NOT {IS_BAD}) AS good, count(*) FILTER (WHERE {IS_BAD}) AS bad
    FROM events GROUP BY 1"""
_RECENT = f"""recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS age FROM events WHERE {IS_BAD}) WHERE age <= 20)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _so_far(column: str) -> str:
    return f"CAST(sum({column}) OVER (ORDER BY window_start) AS BIGINT) AS {column}_so_far"


ORACLES = {
    "review_decisions": """SELECT event_id, CASE WHEN event_type = 'click' THEN 'continue' ELSE 'stop' END AS decision
        FROM events""",
    "run_summary": f"""SELECT user_id, count(*) AS total, count(*) FILTER (WHERE NOT {IS_BAD}) AS good,
        count(*) FILTER (WHERE {IS_BAD}) AS bad,
        count(*) FILTER (WHERE {IS_BAD}) / CAST(count(*) AS DOUBLE) AS error_rate FROM events GROUP BY user_id""",
    "progress_30s": f"""WITH windows AS ({PROGRESS_SQL}) SELECT *, {_so_far('processed')}, {_so_far('good')},
        {_so_far('bad')} FROM windows""",
    "throughput": """SELECT user_id, count(*) AS records, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds,
        CASE WHEN max(ts) = min(ts) THEN 0 ELSE count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) END
        AS records_per_second FROM events GROUP BY user_id""",
    "recent_bad": f"WITH {_RECENT} SELECT user_id, event_id, age FROM recent",
    "bad_digest": f"""WITH {_RECENT}, last AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY age DESC)
        AS n FROM recent WHERE age <= 5) SELECT user_id, count(*) AS samples, {_quoted(monitor.DIGEST_HEAD)} ||
        string_agg(chr(10) || 'Ticket ' || n || ':' || chr(10) || 'Raw data:' || chr(10) || props || chr(10) ||
        'Error reason:' || chr(10) || ({CLASS}) || chr(10), '' ORDER BY n) || {_quoted(monitor.DIGEST_TAIL)} AS digest
        FROM last GROUP BY user_id""",
    "health_decision": f"""WITH {_RECENT}, judged AS (SELECT user_id, count(*) AS samples,
        count(*) FILTER (WHERE value < 20) AS technical FROM recent WHERE age <= 5 GROUP BY user_id)
        SELECT user_id, coalesce(samples, 0) AS samples, coalesce(technical, 0) AS technical,
        CASE WHEN technical / CAST(samples AS DOUBLE) < 0.5 THEN 'continue' ELSE 'stop' END AS decision
        FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN judged USING (user_id)""",
}
