"""Registered redaction queries and their comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.detectors import (
    BADGE,
    CARD,
    CUSTOM_DETECTORS,
    DEFAULT_DETECTORS,
    MACHINE,
    WITH_CUSTOM,
)
from ..operators import durations, monitor, names, redaction
from .tables import LINE, REDUMPED, TICKETS_SQL, answered_lines, documents, table, tickets

# --- comparison SQL ---------------------------------------------------------
# The other engine has no look-around. Word runs are wrapped in control
# characters instead, each entity becomes one private-use character, best score
# first, and the characters are expanded last. That equals span resolution when
# overlapping matches contain each other, which holds on these tables.
_WORD = r"([\p{L}\p{N}_]+)"
_OCTET = r"\x01(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\x02"
_MARKS = {
    "EMAIL_ADDRESS": 57344,
    "CREDIT_CARD": 57345,
    "IP_ADDRESS": 57346,
    "BADGE_NUMBER": 57347,
    "TICKET_NUMBER": 57348,
    "PHONE_NUMBER": 57349,
    "MACHINE_NAME": 57350,
}
_PATTERNS = {
    "IP_ADDRESS": rf"{_OCTET}(?:\.{_OCTET}){{3}}",
    "BADGE_NUMBER": r"\x01\p{Nd}{6}\x02",
    "TICKET_NUMBER": r"\x01(?:[Ii][Nn][Cc]|[Rr][Ee][Qq])\p{Nd}+\x02",
    "PHONE_NUMBER": r"(?:\+\x01[0-9]{1,3}\x02[ .\-]?)?(?:\(\x01[0-9]{3}\x02\)[ .\-]?|\x01[0-9]{3}\x02[.\-])"
    r"\x01[0-9]{3}\x02[ .\-]\x01[0-9]{4}\x02",
    "MACHINE_NAME": r"\x01[A-Z0-9]+(?:(?:_|\x02-\x01)[A-Z0-9]+)*\x02",
}
_LUHN = """lambda h: list_sum(list_transform(range(0, 16), lambda i:
    CASE WHEN i % 2 = 0 THEN CAST(h[17 - i] AS INTEGER)
         WHEN 2 * CAST(h[17 - i] AS INTEGER) > 9 THEN 2 * CAST(h[17 - i] AS INTEGER) - 9
         ELSE 2 * CAST(h[17 - i] AS INTEGER) END)) % 10 = 0"""


def marked_sql(text: str, entities: list[str]) -> str:
    """``text`` with each entity as its private-use character."""
    x = text
    if "EMAIL_ADDRESS" in entities:
        x = rf"regexp_replace({x}, '[A-Za-z0-9_.%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+', chr(57344), 'g')"
    x = f"regexp_replace({x}, '{_WORD}', chr(1) || '\\1' || chr(2), 'g')"
    if "CREDIT_CARD" in entities:
        hits = rf"list_filter(regexp_extract_all(t, '\x01[0-9]{{16}}\x02'), {_LUHN})"
        x = f"""(SELECT list_reduce({hits}, lambda acc, h: replace(acc, h, chr(57345)), t) FROM (SELECT {x} AS t))"""
    for entity, pattern in _PATTERNS.items():
        if entity in entities:
            x = f"regexp_replace({x}, '{pattern}', chr({_MARKS[entity]}), 'g')"
    return f"regexp_replace({x}, '[\\x01\\x02]', '', 'g')"


def expanded_sql(marked: str, entities: list[str]) -> str:
    x = marked
    for entity in entities:
        shown = "<REDACTED>" if entity == "CREDIT_CARD" else f"<{entity}>"
        x = f"replace({x}, chr({_MARKS[entity]}), '{shown}')"
    return x


def redacted_sql(text: str, entities: list[str]) -> str:
    return expanded_sql(marked_sql(text, entities), entities)


_DEFAULT = ["EMAIL_ADDRESS", "CREDIT_CARD", "IP_ADDRESS", "PHONE_NUMBER"]
_ALL = _DEFAULT + ["BADGE_NUMBER", "TICKET_NUMBER", "MACHINE_NAME"]


# --- queries ----------------------------------------------------------------
def redact_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return redaction.redact_columns(docs, ["text"], DEFAULT_DETECTORS)


def redact_english(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return redaction.redact_columns(docs, ["text"], DEFAULT_DETECTORS, language=F.col("lang"))


def redact_distinct(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return redaction.redact_distinct(docs, "text", DEFAULT_DETECTORS)


def redact_memo(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return redaction.redact_columns(docs, ["text"], DEFAULT_DETECTORS, memo=1024)


def redact_cards(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    # Exploded, not filtered on their number: a filter would analyse each text twice.
    found = docs.select("doc_id", F.explode(redaction.analyze(F.col("text"), [CARD])))
    return found.groupBy("doc_id").agg(F.count("*").alias("cards"))


def redact_machine_names(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return redaction.redact_columns(docs, ["text"], [MACHINE])


def redact_tickets_custom(spark: SparkSession, folder: str) -> DataFrame:
    rows = tickets(spark, folder).select("ticket_id", "Short_Description", "Description")
    return redaction.redact_columns(rows, detectors=WITH_CUSTOM)


def redact_json_records(spark: SparkSession, folder: str) -> DataFrame:
    lines = answered_lines(spark, folder).select("ticket_id", "value")
    return redaction.redact_json_lines(lines, "value", DEFAULT_DETECTORS)


def redact_context_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = tickets(spark, folder).select("ticket_id", "Description")
    found = redaction.analyze(F.col("Description"), [BADGE], context=True)
    return rows.select("ticket_id", F.explode(found).alias("s")).select(
        "ticket_id",
        F.col("s.start").cast("bigint").alias("start"),
        F.round("s.score", 6).alias("score"),
    )


def mask_known_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = tickets(spark, folder).select("ticket_id", "Description")
    people = table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    return names.mask_names(rows, "ticket_id", "Description", people)


def mask_known_names_joined(spark: SparkSession, folder: str) -> DataFrame:
    rows = tickets(spark, folder).select("ticket_id", "Description")
    people = table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    return names.mask_names(rows, "ticket_id", "Description", people, ship=False)


def entity_usage(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("text")
    kept = redaction.analyze(F.col("text"), DEFAULT_DETECTORS, resolved=True)
    return redaction.entity_usage(docs.select(kept.alias("spans")))


def redaction_metrics(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("text")
    done = docs.withColumn("redacted", redaction.redact(F.col("text"), DEFAULT_DETECTORS))
    failed = F.size(redaction.failed_columns(["redacted"])) > 0
    return monitor.redaction_metrics(done, F.col("text"), failed)


def detector_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = tickets(spark, folder).select("Description")
    found = rows.withColumn("found", redaction.analyze(F.col("Description"), CUSTOM_DETECTORS))
    return monitor.detector_metrics(found, F.col("Description"), F.col("found"), CUSTOM_DETECTORS)


def detector_timings(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and matches of each detector from its time sketch, and whether its quantiles are in order."""
    sketch = durations.timed(tickets(spark, folder).select("Description"), "Description", CUSTOM_DETECTORS)
    ordered = (F.col("p50") > 0) & (F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("p99"))
    return durations.quantiles(sketch).select("entity", "texts", "matches", ordered.alias("ordered"))


QUERIES = {
    f.__name__: f
    for f in (
        redact_documents,
        redact_english,
        redact_distinct,
        redact_memo,
        redact_cards,
        redact_machine_names,
        redact_tickets_custom,
        redact_json_records,
        redact_context_scores,
        mask_known_names,
        mask_known_names_joined,
        entity_usage,
        redaction_metrics,
        detector_metrics,
        detector_timings,
    )
}

_DOCS_SQL = f"SELECT doc_id, lang, {redacted_sql('text', _DEFAULT)} AS text FROM documents"
_NAMES_SQL = f"""WITH {TICKETS_SQL}, people AS (SELECT DISTINCT c_name FROM customer)
    SELECT ticket_id, CASE WHEN c_name IS NULL THEN Description
        ELSE '<PERSON>' || substr(Description, length(customer_name) + 1) END AS Description
    FROM tickets LEFT JOIN people ON c_name = customer_name"""


def _matches_sql(pattern: str) -> str:
    wrapped = f"regexp_replace(Description, '{_WORD}', chr(1) || '\\1' || chr(2), 'g')"
    return f"len(regexp_extract_all({wrapped}, '{pattern}'))"


ORACLES = {
    "redact_documents": _DOCS_SQL,
    "redact_english": f"""SELECT doc_id, lang, CASE WHEN lang = 'en' THEN {redacted_sql('text', _DEFAULT)}
        ELSE text END AS text FROM documents""",
    "redact_distinct": _DOCS_SQL,
    "redact_memo": _DOCS_SQL,
    "redact_cards": rf"""SELECT doc_id, cards FROM (SELECT doc_id, len(list_filter(regexp_extract_all(
        regexp_replace(text, '{_WORD}', chr(1) || '\1' || chr(2), 'g'), '\x01[0-9]{{16}}\x02'), {_LUHN})) AS cards
        FROM documents) WHERE cards > 0""",
    "redact_machine_names": f"""SELECT doc_id, {redacted_sql('text', ['MACHINE_NAME'])} AS text FROM documents""",
    "redact_tickets_custom": f"""WITH {TICKETS_SQL} SELECT ticket_id,
        {redacted_sql('Short_Description', _ALL)} AS Short_Description,
        {redacted_sql('Description', _ALL)} AS Description FROM tickets""",
    "redact_json_records": f"""WITH {TICKETS_SQL} SELECT ticket_id, CASE WHEN reject IS NULL
            THEN {redacted_sql('redumped', _DEFAULT)} END AS value, reject
        FROM (SELECT ticket_id, {REDUMPED} AS redumped, CASE WHEN NOT json_valid(line) THEN 'invalid_json'
            WHEN json_type(line) <> 'OBJECT' THEN 'not_an_object' END AS reject
            FROM (SELECT *, {LINE} AS line FROM tickets))""",
    "redact_context_scores": rf"""WITH {TICKETS_SQL}, found AS (SELECT ticket_id, Description,
            regexp_extract_all(Description, '[\p{{L}}\p{{N}}_]+') AS words,
            regexp_extract(Description, '(?:badge|employee ID|id number) ([0-9]{{6}}) ', 1) AS badge FROM tickets),
        placed AS (SELECT *, list_position(words, badge) AS pos FROM found),
        near AS (SELECT ticket_id, Description, badge,
            ' ' || lower(array_to_string(list_slice(words, greatest(pos - 5, 1), pos - 1), ' ')) || ' ' AS before,
            ' ' || lower(array_to_string(list_slice(words, pos + 1, pos + 5), ' ')) || ' ' AS after FROM placed)
        SELECT ticket_id, strpos(Description, ' ' || badge || ' ') AS start,
            CASE WHEN regexp_matches(before, ' (badge number|employee id|id number) ')
                OR regexp_matches(after, ' (badge number|employee id|id number) ')
                THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS score
        FROM near""",
    "mask_known_names": _NAMES_SQL,
    "mask_known_names_joined": _NAMES_SQL,
    "entity_usage": f"""WITH marked AS (SELECT {marked_sql('text', _DEFAULT)} AS t FROM documents),
        counted AS ({' UNION ALL '.join(
            f"SELECT '{e}' AS entity, sum(length(t) - length(replace(t, chr({_MARKS[e]}), ''))) AS uses FROM marked"
            for e in _DEFAULT)})
        SELECT entity, CAST(uses AS BIGINT) AS uses FROM counted WHERE uses > 0""",
    "redaction_metrics": """SELECT texts, chars, CAST(0 AS BIGINT) AS errors, CAST(0 AS DOUBLE) AS error_rate,
        distinct_texts, CASE WHEN texts = 0 THEN 0 ELSE (texts - distinct_texts) / CAST(texts AS DOUBLE) END
        AS memo_hit_ratio FROM (SELECT count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS chars,
        count(DISTINCT text) AS distinct_texts FROM documents WHERE length(text) > 0)""",
    "detector_metrics": f"""WITH {TICKETS_SQL}, counted AS ({' UNION ALL '.join(
        f"SELECT '{e}' AS entity, count(*) AS patterns_checked, CAST(sum({_matches_sql(_PATTERNS[e])}) AS BIGINT) "
        "AS matches_found FROM tickets WHERE length(Description) > 0"
        for e in ("BADGE_NUMBER", "TICKET_NUMBER", "MACHINE_NAME"))})
        SELECT entity, patterns_checked, matches_found,
            matches_found / CAST(patterns_checked AS DOUBLE) AS match_ratio FROM counted""",
    "detector_timings": f"""WITH {TICKETS_SQL}, counted AS ({' UNION ALL '.join(
        f"SELECT '{e}' AS entity, count(*) AS texts, CAST(sum({_matches_sql(_PATTERNS[e])}) AS BIGINT) "
        "AS matches FROM tickets WHERE length(Description) > 0"
        for e in ("BADGE_NUMBER", "TICKET_NUMBER", "MACHINE_NAME"))})
        SELECT entity, texts, matches, true AS ordered FROM counted
        UNION ALL SELECT 'text', max(texts), CAST(sum(matches) AS BIGINT), true FROM counted""",
}
