"""Registered streaming queries: each equals its batch twin."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import folds
from ..functions.detectors import DEFAULT_DETECTORS
from ..functions.time import epoch_micros
from ..operators import gates, monitor, redaction, sequence
from ..session import run_folder
from ..streaming import folds as state
from ..streaming import jobs
from . import curation, monitoring, sequences
from . import redaction as redaction_plans
from .monitoring import is_bad
from .tables import ANSWER_COLUMNS, TICKET_COLUMNS, table


def _events(spark: SparkSession, folder: str) -> DataFrame:
    events = jobs.stream_table(spark, folder, "events")
    return events.select("user_id", "ts", "event_id", "event_type")


def _folded(spark: SparkSession, folder: str, fold, name: str, value, again) -> DataFrame:
    """The event log folded as it arrives; ``again`` is the batch twin for keys with late rows."""
    events = _events(spark, folder)
    rows = state.stream_fold(events, "user_id", "ts", "event_id", {name: value}, fold)
    out = spark.read.parquet(jobs.drain(jobs.append_to, rows, run_folder(spark, "stream")))
    return state.settled(out, "user_id", fold, again)


def _at(events: DataFrame):
    return epoch_micros(events, F.col("ts"))


def stream_ema(spark: SparkSession, folder: str) -> DataFrame:
    def again(rows: DataFrame) -> DataFrame:
        return sequence.ema(rows, "user_id", sequences.ORDER, is_bad())

    x = F.when(is_bad(), 1.0).otherwise(0.0)
    averaged = _folded(spark, folder, folds.Ema(sequence.EMA_ALPHA), "x", x, again)
    return averaged.select("user_id", "event_id", F.round("ema", 10).alias("ema"))


def stream_ema_resets(spark: SparkSession, folder: str) -> DataFrame:
    levels = {"warn": sequences.WARN, "stop": sequences.STOP}

    def again(rows: DataFrame) -> DataFrame:
        return sequence.ema_with_resets(rows, "user_id", sequences.ORDER, is_bad(), **levels)

    x = F.when(is_bad(), 1.0).otherwise(0.0)
    averaged = _folded(spark, folder, folds.ResettingEma(sequence.EMA_ALPHA, **levels), "x", x, again)
    return averaged.select("user_id", "event_id", F.round("ema", 10).alias("ema"), "alert")


def stream_streaks(spark: SparkSession, folder: str) -> DataFrame:
    def again(rows: DataFrame) -> DataFrame:
        return sequence.failure_streaks(rows, "user_id", sequences.ORDER, is_bad())

    log = _folded(spark, folder, folds.Streak(), "bad", F.coalesce(is_bad(), F.lit(False)), again)
    return log.select("user_id", "event_id", "streak")


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    windows = jobs.progress_stream(_events(spark, folder), "ts", is_bad())
    out = jobs.drain(jobs.upsert_to, windows, run_folder(spark, "stream"))
    # The log has no zone, so neither have its windows.
    rows = jobs.latest(spark, out, ["window_start"])
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_recent_bad(spark: SparkSession, folder: str) -> DataFrame:
    bad = _events(spark, folder).filter(is_bad()).withColumn("at", _at(_events(spark, folder))).drop("ts")
    recent = state.stream_recent(bad, "user_id", ["at", "event_id"], [], monitor.RECENT_BAD)
    out = jobs.drain(jobs.upsert_to, recent, run_folder(spark, "stream"))
    # A key is rewritten whole: its newest batch is its current buffer.
    rows = spark.read.parquet(out)
    newest = rows.groupBy("user_id").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["user_id", "batch"]).select(
        "user_id", "event_id", F.col("age").cast("bigint").alias("age")
    )


def stream_redact(spark: SparkSession, folder: str) -> DataFrame:
    docs = jobs.stream_table(spark, folder, "documents").select("doc_id", "lang", "text")
    redacted = redaction.redact_columns(docs, ["text"], DEFAULT_DETECTORS)
    return spark.read.parquet(jobs.drain(jobs.append_to, redacted, run_folder(spark, "stream")))


def stream_route(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets from an order stream joined with the customer table, routed per batch."""
    orders = jobs.stream_table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.selectExpr(*[f"{e} AS {n}" for n, e in TICKET_COLUMNS.items()])
    lines = rows.selectExpr("ticket_id", *[f"{e} AS {n}" for n, e in ANSWER_COLUMNS.items()])
    routed = gates.classify(
        gates.raw_tickets(lines),
        refusal="refusal",
        call_error="call_error",
        call_class="call_class",
        seconds="seconds",
    )
    out = jobs.drain(jobs.route_stream, routed, run_folder(spark, "stream"))
    read = {
        "good": ["instruction", "response", "category", "subcategory", "assignment_group"],
        "bad": ["raw_ticket", "error", "error_class"],
        "transactions": ["ticket_json", "request_payload", "raw_response"],
    }
    sinks = [
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .json(f"{out}/{sink}")
        .select(F.lit(sink).alias("sink"), F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in columns]).alias("row"))
        for sink, columns in read.items()
    ]
    return reduce(DataFrame.unionByName, sinks)


QUERIES = {
    f.__name__: f
    for f in (
        stream_ema,
        stream_ema_resets,
        stream_streaks,
        stream_progress,
        stream_recent_bad,
        stream_redact,
        stream_route,
    )
}

ORACLES = {
    "stream_ema": sequences.ORACLES["bad_ratio_ema"],
    "stream_ema_resets": sequences.ORACLES["ema_resets"],
    "stream_streaks": sequences.ORACLES["failure_streaks"],
    "stream_progress": monitoring.PROGRESS_SQL,
    "stream_recent_bad": monitoring.ORACLES["recent_bad"],
    "stream_redact": redaction_plans.ORACLES["redact_documents"],
    "stream_route": " UNION ALL ".join(
        f"SELECT '{sink}' AS sink, concat_ws('|', {', '.join(f"coalesce({c}, '-')" for c in columns)}) AS \"row\" "
        f"FROM ({curation.ORACLES[query]})"
        for sink, query, columns in (
            ("good", "good_tickets", ["instruction", "response", "category", "subcategory", "assignment_group"]),
            ("bad", "bad_tickets", ["raw_ticket", "error", "error_class"]),
            ("transactions", "transactions", ["ticket_json", "request_payload", "raw_response"]),
        )
    ),
}
