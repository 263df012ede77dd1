"""Registered queries of the curation stage: verdicts, gates, routing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import GOOD_FIELDS
from ..operators import gates, ledger, monitor, routing
from ..session import run_folder
from ..settings import Settings
from .tables import ANSWERS_SQL, answered_lines, table

PACK_WIDTH = 64  # documents per shard: ids are unique, so a shard is bounded


def routed(spark: SparkSession, folder: str, settings: Settings = Settings()) -> DataFrame:
    lines = gates.raw_tickets(answered_lines(spark, folder))
    return gates.classify(
        lines,
        refusal="refusal",
        call_error="call_error",
        call_class="call_class",
        seconds="seconds",
        min_words=settings.min_word_count,
        timeout=settings.ticket_timeout_seconds,
    )


def verdict_parse(spark: SparkSession, folder: str) -> DataFrame:
    answers = answered_lines(spark, folder).select("ticket_id", "response")
    parsed = answers.select("ticket_id", gates.parse_response(F.col("response")).alias("p"))
    return parsed.select(
        "ticket_id",
        F.coalesce("p.valid", F.lit(False)).alias("valid"),
        "p.status",
        F.when(~F.col("p.object"), F.col("p.reason")).alias("reason"),
        F.col("p.ticket").isNotNull().alias("has_ticket"),
        F.col("p.ticket.instruction").alias("instruction"),
    )


def route_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return routed(spark, folder).select("ticket_id", "status", "error_class", "error", "answered")


def good_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return routing.good_rows(routed(spark, folder))


def bad_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return routing.bad_rows(routed(spark, folder))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return routing.transactions(routed(spark, folder))


def bad_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.bad_reasons(routed(spark, folder))


def routing_summary(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.run_summary(routed(spark, folder), F.col("status") == "bad")


def model_step(spark: SparkSession, folder: str) -> DataFrame:
    """A caller's model as a batch function, then the gates."""

    def echo(requests):
        """Stands in for a model: marks each ticket as bad with its size as the reason."""
        return requests.map(lambda r: None if r is None else f'{{"status":"bad","data":"{len(r)} characters"}}')

    lines = gates.raw_tickets(answered_lines(spark, folder).select("ticket_id", "value"))
    answered = gates.with_model(lines, echo)
    return gates.classify(answered).select("ticket_id", "status", "error_class", "error")


def model_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Requests answered through a ledger by two runs, the second over all of them; each distinct request is sent once."""
    answers = run_folder(spark, "ledger")

    def echo(requests):
        return requests.map(lambda r: f"{len(r)} characters")

    # Stored, since reading the tickets costs more than all the rest and three jobs need their requests.
    stored = run_folder(spark, "payloads")
    made = gates.raw_tickets(answered_lines(spark, folder).select("ticket_id", "value")).select("ticket_id", "request_payload")
    made.write.parquet(stored)
    lines = spark.read.schema(made.schema).parquet(stored)
    ledger.with_ledger(lines.filter("ticket_id % 2 = 0"), echo, answers)
    done = ledger.with_ledger(lines, echo, answers)
    sent = spark.read.schema("hash string, answer string").parquet(answers).groupBy("hash").count()
    return done.select("ticket_id", "response", F.lit(sent.filter("count > 1").count()).cast("long").alias("sent_again"))


def timeout_gate(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "events").select("event_id", "value")
    return log.select("event_id", gates.timeout_reason(F.col("value"), 30).alias("error")).filter(
        "error IS NOT NULL"
    )


def slow_ops(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "events").select("event_id", "value")
    return monitor.slow_operations(log, "value", monitor.SLOW_REDACTION)


def wrapped_errors(spark: SparkSession, folder: str) -> DataFrame:
    return routing.wrap_errors(bad_tickets(spark, folder), "error").select(
        F.to_json(F.struct("error")).alias("line")
    )


def pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    shard = F.floor(F.col("doc_id") / PACK_WIDTH).cast("bigint").alias("shard")
    section = routing.packed_section(F.col("doc_id").cast("string"), F.col("text"), "text")
    return routing.pack_shards(docs, [F.col("source"), shard], F.col("doc_id"), section)


QUERIES = {
    f.__name__: f
    for f in (
        verdict_parse,
        route_tickets,
        good_tickets,
        bad_tickets,
        transactions,
        bad_reasons,
        routing_summary,
        model_step,
        model_ledger,
        timeout_gate,
        slow_ops,
        wrapped_errors,
        pack_documents,
    )
}

_WORDS = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+'))"


def _text(path: str) -> str:
    return f"json_extract_string(response, '{path}')"


_PARSED = f"""parsed AS (SELECT *,
    coalesce(json_type(response) = 'OBJECT' AND list_sort(json_keys(response)) = ['data', 'status']
        AND {_text('$.status')} IN ('good', 'bad')
        AND json_type(response, '$.data') IN ('OBJECT', 'VARCHAR'), false) AS valid,
    {_text('$.status')} AS said, json_type(response, '$.data') AS kind, {_text('$.data')} AS data_text,
    CASE WHEN json_type(response, '$.data') = 'OBJECT' THEN coalesce(
        list_sort(json_keys(response, '$.data')) = ['assignment_group', 'category', 'instruction', 'response', 'subcategory']
        AND {' AND '.join(f"json_type(response, '$.data.{n}') = 'VARCHAR'" for n in GOOD_FIELDS)}, false)
        ELSE false END AS pair_ok FROM answers)"""
_LINE_BAD = "trim(value) = '' OR NOT json_valid(value)"
_JSON = "CASE WHEN json_valid(value) THEN value END"
_SHAPE = f"""coalesce(json_type({_JSON}) = 'OBJECT'
    AND coalesce(json_type({_JSON}, '$.Category'), 'NULL') IN ('VARCHAR', 'NULL'), false)"""
# The decoder's own message for the one kind of cut line.
_CUT = "Invalid JSON: Expecting value: line 1 column 13 (char 12)"
_ROUTED = f"""WITH {ANSWERS_SQL}, {_PARSED}, why AS (SELECT *, CASE
    WHEN seconds > 180 THEN ['timeout', 'Ticket timed out after ' || CAST(floor(seconds) AS BIGINT) || 's']
    WHEN trim(value) = '' THEN ['invalid_json', 'Invalid JSON: blank line']
    WHEN NOT json_valid(value) THEN ['invalid_json', '{_CUT}']
    WHEN NOT {_SHAPE} THEN ['invalid_shape', 'Ticket is not an object with six text fields']
    WHEN call_class = 'rate_limited' THEN ['rate_limited', 'Shutdown requested mid-rate-limit']
    WHEN call_class = 'breaker_open' THEN ['breaker_open', 'Circuit breaker open (requests not allowed)']
    WHEN call_class IS NULL AND (refusal IS NOT NULL OR response IS NULL) THEN ['refusal', 'Failed to parse LLM response']
    WHEN call_class = 'api_error' THEN ['api_error', 'API Error (final): ' || call_error]
    WHEN call_class = 'unexpected' THEN ['unexpected', 'Worker unexpected final fail: ' || call_error]
    WHEN NOT valid THEN ['unexpected', 'Worker unexpected final fail: answer does not match the response schema']
    WHEN said = 'bad' THEN ['model_bad', coalesce(nullif(data_text, ''), 'LLM says BAD with no reason')]
    WHEN kind = 'OBJECT' AND NOT pair_ok THEN ['schema_error', 'TicketSchema validation error']
    WHEN kind <> 'OBJECT' THEN ['no_data', 'No parsed data in LLM response']
    WHEN {_WORDS.format(_text('$.data.instruction'))} < 5 OR {_WORDS.format(_text('$.data.response'))} < 5
        THEN ['too_short', 'Instruction or response too short'] END AS why FROM parsed),
    routed AS (SELECT *, CASE WHEN why IS NULL THEN 'good' ELSE 'bad' END AS status,
        why[1] AS error_class, why[2] AS error,
        coalesce(call_class IS NULL AND NOT ({_LINE_BAD}) AND {_SHAPE} AND response IS NOT NULL
            AND (refusal IS NOT NULL OR valid), false) AS answered FROM why)"""

_REQUEST = (
    "concat('{', "
    + ", ',', ".join(
        f"""'"{n}":"', coalesce(json_extract_string({_JSON}, '$.{n}'), 'unknown'), '"'"""
        for n in ("Short_Description", "Description", "Close_Notes", "Category", "Subcategory", "Assignment_Group")
    )
    + ", '}')"
)

ORACLES = {
    "verdict_parse": f"""WITH {ANSWERS_SQL}, {_PARSED} SELECT ticket_id, valid, said AS status,
        CASE WHEN kind <> 'OBJECT' THEN data_text END AS reason, pair_ok AS has_ticket,
        CASE WHEN pair_ok THEN {_text('$.data.instruction')} END AS instruction
        FROM parsed""",
    "route_tickets": f"{_ROUTED} SELECT ticket_id, status, error_class, error, answered FROM routed",
    "good_tickets": f"""{_ROUTED} SELECT {', '.join(f"{_text('$.data.' + n)} AS {n}" for n in GOOD_FIELDS)}
        FROM routed WHERE status = 'good'""",
    "bad_tickets": f"{_ROUTED} SELECT value AS raw_ticket, error, error_class FROM routed WHERE status = 'bad'",
    "transactions": f"""{_ROUTED} SELECT value AS ticket_json, {_REQUEST} AS request_payload,
        response AS raw_response FROM routed WHERE answered""",
    "bad_reasons": f"""{_ROUTED} SELECT error_class, count(*) AS tickets FROM routed
        WHERE status = 'bad' GROUP BY error_class""",
    "routing_summary": f"""{_ROUTED} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'good') AS good,
        count(*) FILTER (WHERE status = 'bad') AS bad,
        count(*) FILTER (WHERE status = 'bad') / CAST(count(*) AS DOUBLE) AS error_rate FROM routed""",
    "model_step": f"""WITH {ANSWERS_SQL}, shaped AS (SELECT ticket_id, value, CASE
        WHEN trim(value) = '' THEN ['invalid_json', 'Invalid JSON: blank line']
        WHEN NOT json_valid(value) THEN ['invalid_json', '{_CUT}']
        WHEN NOT {_SHAPE} THEN ['invalid_shape', 'Ticket is not an object with six text fields']
        ELSE ['model_bad', length({_REQUEST}) || ' characters'] END AS why FROM answers)
        SELECT ticket_id, 'bad' AS status, why[1] AS error_class, why[2] AS error FROM shaped""",
    "model_ledger": f"""WITH {ANSWERS_SQL}, shaped AS (SELECT ticket_id, CASE
        WHEN trim(value) <> '' AND json_valid(value) AND {_SHAPE} THEN length({_REQUEST}) || ' characters' END AS response FROM answers)
        SELECT ticket_id, response, 0::BIGINT AS sent_again FROM shaped""",
    "timeout_gate": """SELECT event_id, 'Ticket timed out after ' || CAST(floor(value) AS BIGINT) || 's' AS error
        FROM events WHERE value > 30""",
    "slow_ops": "SELECT event_id, value FROM events WHERE value > 1.0",
    "wrapped_errors": f"""{_ROUTED} SELECT concat('{{"error":"', error, '"}}') AS line FROM routed
        WHERE status = 'bad'""",
    "pack_documents": f"""SELECT source, doc_id // {PACK_WIDTH} AS shard, count(*) AS files,
        string_agg('## File: ' || doc_id || chr(10) || chr(10) || '```text' || chr(10) || text || chr(10)
            || '```' || chr(10) || chr(10), '' ORDER BY doc_id) AS packed
        FROM documents GROUP BY ALL""",
}
