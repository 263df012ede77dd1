"""Registered queries over JSON lines and ticket fields."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from ..functions.text import word_count
from ..operators import records
from ..operators.gates import raw_tickets, too_few_words
from .tables import (
    ANSWERS_SQL,
    PAIRS_SQL,
    SPOILT_SQL,
    TICKETS_SQL,
    answered_lines,
    pairs,
    spoilt_lines,
    table,
    tickets,
)


def json_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    judged = records.with_verdict(spoilt_lines(spark, folder), dump=False)
    return judged.select("event_id", F.col("json.verdict").alias("verdict"), F.col("json.kind").alias("kind"))


def reformat_events(spark: SparkSession, folder: str) -> DataFrame:
    return records.reformat(spoilt_lines(spark, folder)).select("event_id", "value")


def reformat_report(spark: SparkSession, folder: str) -> DataFrame:
    return records.reformat_report(records.with_verdict(spoilt_lines(spark, folder), dump=False))


def valid_counts(spark: SparkSession, folder: str) -> DataFrame:
    judged = records.with_verdict(spoilt_lines(spark, folder), strip_line=False, dump=False)
    return records.count_records(judged)


def line_integrity(spark: SparkSession, folder: str) -> DataFrame:
    judged = records.with_verdict(spoilt_lines(spark, folder), strip_line=False, dump=False)
    return records.integrity(judged, ["user_id"], F.col("event_id"))


def object_records(spark: SparkSession, folder: str) -> DataFrame:
    judged = records.with_verdict(spoilt_lines(spark, folder))
    return records.objects(judged).select("event_id", F.col("json.line").alias("value"))


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    judged = records.with_verdict(spoilt_lines(spark, folder), dump=False)
    rejected = records.rejects(judged, ["event_id", "value"], objects_only=True)
    kind = F.when(F.startswith("reason", F.lit("Invalid JSON")), "invalid").otherwise(F.col("reason"))
    return rejected.select("event_id", "value", kind.alias("reason"))


def io_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return records.io_metrics(records.with_verdict(spoilt_lines(spark, folder), dump=False))


def blank_to_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = tickets(spark, folder)
    return rows.select(
        "ticket_id",
        *[fields.blank_to_null(F.col(n), fields.MISSING_MARKERS).alias(n) for n in fields.TICKET_FIELDS],
    )


def fill_missing(spark: SparkSession, folder: str) -> DataFrame:
    return tickets(spark, folder).select("ticket_id", *fields.six_fields())


def ticket_payload(spark: SparkSession, folder: str) -> DataFrame:
    return tickets(spark, folder).select("ticket_id", fields.payload().alias("payload"))


def ticket_shape(spark: SparkSession, folder: str) -> DataFrame:
    lines = answered_lines(spark, folder).select("ticket_id", "value")
    return raw_tickets(lines).select("ticket_id", "shape_ok", "request_payload")


def training_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return fields.training_pairs(tickets(spark, folder), ["ticket_id"])


def model_requests(spark: SparkSession, folder: str) -> DataFrame:
    request = fields.model_request(fields.payload(), "curator", prompt="Curate this ticket.")
    return tickets(spark, folder).select("ticket_id", request.alias("request"))


def word_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Words are counted before the turns are paired: the join moves counts, not texts."""
    turns = pairs(spark, folder, word_count(F.col("text")))
    return turns.select(
        "conv_id", "turn", too_few_words([F.col("instruction"), F.col("response")], 25).alias("too_short")
    )


def language_split(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts"), F.bool_and(F.col("lang") == "en").alias("analysed")
    )


QUERIES = {
    f.__name__: f
    for f in (
        json_verdicts,
        reformat_events,
        reformat_report,
        valid_counts,
        line_integrity,
        object_records,
        quarantine,
        io_metrics,
        blank_to_null,
        fill_missing,
        ticket_payload,
        ticket_shape,
        training_pairs,
        model_requests,
        word_gate,
        language_split,
    )
}

_BLANK = "trim(value) = ''"
# The other engine lets a trailing comma pass; a strict reader does not.
_VALID = "(json_valid(value) AND NOT regexp_matches(value, ',[}\\]]'))"
_OK = f"(NOT {_BLANK} AND {_VALID})"
_BAD = f"(NOT {_BLANK} AND NOT {_VALID})"
_KIND = "CASE json_type(value) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' END"
_REDUMP = """CASE value WHEN '{"a":1,"a":2}' THEN '{"a": 2}' WHEN '[1,2]' THEN '[1, 2]'
    WHEN '{"b":1,"a":2.0}' THEN '{"b": 1, "a": 2.0}' ELSE value END"""


def _filled(name: str) -> str:
    return f"coalesce({name}, 'unknown')"


_PAYLOAD = (
    "concat('{', "
    + ", ',', ".join(f"""'"{n}":"', {_filled(n)}, '"'""" for n in fields.TICKET_FIELDS)
    + ", '}')"
)
_PHONE = r"\+1 \(555\) 010-[0-9]{4}"
_MERGED = "concat_ws(' ', nullif(trim(Short_Description), ''), Description)"
_SCHEMA = json.dumps(fields.response_schema(), separators=(",", ":"))

_MARKERS = ", ".join(f"'{m}'" for m in fields.MISSING_MARKERS)
_JSON = "CASE WHEN json_valid(value) THEN value END"

ORACLES = {
    "json_verdicts": f"""WITH {SPOILT_SQL} SELECT event_id,
        CASE WHEN {_BLANK} THEN 'blank' WHEN {_VALID} THEN 'ok' ELSE 'invalid' END AS verdict,
        CASE WHEN {_OK} THEN {_KIND} END AS kind FROM lines""",
    "reformat_events": f"WITH {SPOILT_SQL} SELECT event_id, {_REDUMP} AS value FROM lines WHERE {_OK}",
    "reformat_report": f"""WITH {SPOILT_SQL} SELECT count(*) AS total_lines,
        count(*) FILTER (WHERE {_OK}) AS valid_lines, count(*) FILTER (WHERE NOT {_OK}) AS invalid_lines FROM lines""",
    "valid_counts": f"""WITH {SPOILT_SQL} SELECT count(*) FILTER (WHERE {_OK}) AS valid_records,
        count(*) FILTER (WHERE {_BAD}) AS invalid_records FROM lines""",
    "line_integrity": f"""WITH {SPOILT_SQL} SELECT user_id, count(*) FILTER (WHERE {_BAD}) = 0 AS is_valid,
        min(event_id) FILTER (WHERE {_BAD}) AS first_bad_line FROM lines GROUP BY user_id""",
    "object_records": f"""WITH {SPOILT_SQL} SELECT event_id, {_REDUMP} AS value FROM lines
        WHERE {_OK} AND json_type(value) = 'OBJECT'""",
    "quarantine": f"""WITH {SPOILT_SQL} SELECT event_id, value,
        CASE WHEN {_BAD} THEN 'invalid' ELSE 'not an object: ' || {_KIND} END AS reason FROM lines
        WHERE {_BAD} OR ({_OK} AND json_type(value) <> 'OBJECT')""",
    "io_metrics": f"""WITH {SPOILT_SQL} SELECT CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes_read,
        count(*) AS read_operations, count(*) FILTER (WHERE {_BAD}) AS error_count FROM lines""",
    "blank_to_null": f"""WITH {TICKETS_SQL} SELECT ticket_id,
        {', '.join(f"CASE WHEN {n} NOT IN ({_MARKERS}) THEN nullif(trim({n}), '') END AS {n}" for n in fields.TICKET_FIELDS)}
        FROM tickets""",
    "fill_missing": f"""WITH {TICKETS_SQL} SELECT ticket_id,
        {', '.join(f"{_filled(n)} AS {n}" for n in fields.TICKET_FIELDS)} FROM tickets""",
    "ticket_payload": f"WITH {TICKETS_SQL} SELECT ticket_id, {_PAYLOAD} AS payload FROM tickets",
    "ticket_shape": f"""WITH {ANSWERS_SQL}, shaped AS (SELECT ticket_id, coalesce(json_type({_JSON}) = 'OBJECT' AND
        {' AND '.join(f"coalesce(json_type({_JSON}, '$.{n}'), 'NULL') IN ('VARCHAR', 'NULL')" for n in fields.TICKET_FIELDS)},
        false) AS shape_ok FROM answers) SELECT ticket_id, shape_ok, CASE WHEN shape_ok THEN {_PAYLOAD} END AS request_payload
        FROM shaped JOIN tickets USING (ticket_id)""",
    "training_pairs": rf"""WITH {TICKETS_SQL} SELECT ticket_id,
        trim(regexp_replace(regexp_replace({_MERGED}, '{_PHONE}', '', 'g'), '[ \t]+', ' ', 'g')) AS instruction,
        coalesce(Close_Notes, '') AS response, {_filled('Category')} AS category,
        {_filled('Subcategory')} AS subcategory, {_filled('Assignment_Group')} AS assignment_group FROM tickets""",
    "model_requests": f"""WITH {TICKETS_SQL} SELECT ticket_id, concat(
        '{{"model":"curator","messages":[{{"role":"system","content":"Curate this ticket."}},',
        '{{"role":"user","content":"', replace({_PAYLOAD}, '"', '\\"'), '"}}],"max_tokens":1000,"temperature":0.0',
        ',"response_format":{_SCHEMA}}}') AS request FROM tickets""",
    "word_gate": rf"""WITH {PAIRS_SQL} SELECT conv_id, turn,
        len(regexp_extract_all(instruction, '[\p{{L}}\p{{N}}_]+')) < 25
        OR len(regexp_extract_all(response, '[\p{{L}}\p{{N}}_]+')) < 25 AS too_short FROM pairs""",
    "language_split": "SELECT lang, count(*) AS texts, bool_and(lang = 'en') AS analysed FROM documents GROUP BY lang",
}
