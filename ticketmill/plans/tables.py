"""Input tables of the registered queries.

The test data has no ticket table, so tickets, their model answers and their
JSON lines are derived from orders and customers by SQL expressions that Spark
and the comparison engine read alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import TICKET_FIELDS
from ..session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_KEY = "o_orderkey"
TICKET_COLUMNS = {
    "ticket_id": _KEY,
    "customer_name": "c_name",
    "opened": "o_orderdate",
    "Short_Description": f"""CASE WHEN {_KEY} % 13 = 0 THEN NULL WHEN {_KEY} % 17 = 0 THEN '   '
        ELSE concat('  INC', lpad(concat('', {_KEY}), 7, '0'), ' ', o_orderpriority, ' ') END""",
    "Description": f"""concat(c_name,
        CASE WHEN {_KEY} % 3 = 0 THEN ' badge ' WHEN {_KEY} % 3 = 1 THEN ' employee ID ' ELSE ' id number ' END,
        lpad(concat('', o_custkey), 6, '0'), ' on PC-', {_KEY} % 97,
        ' call +1 (555) 010-', lpad(concat('', {_KEY} % 10000), 4, '0'),
        ' mail u', o_custkey, '@corp.example.com from 10.0.', {_KEY} % 256, '.', o_custkey % 256)""",
    "Close_Notes": """CASE o_orderstatus WHEN 'F' THEN 'Replaced the cable and restarted the machine for them.'
        WHEN 'O' THEN 'Pending' END""",
    "Category": f"CASE WHEN {_KEY} % 31 = 0 THEN 'N/A' WHEN {_KEY} % 37 = 0 THEN 'null' ELSE c_mktsegment END",
    "Subcategory": "o_orderpriority",
    "Assignment_Group": f"CASE WHEN {_KEY} % 11 = 0 THEN NULL ELSE concat('GRP-', c_nationkey) END",
}


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for per-row work on the text."""
    return spread(table(spark, folder, "documents").select("doc_id", "lang", "text"))


def _json_text(column: str) -> str:
    return f"""CASE WHEN {column} IS NULL THEN 'null' ELSE concat('"', {column}, '"') END"""


def _json_object(pairs: dict[str, str], colon: str = ":", comma: str = ",") -> str:
    parts = f", '{comma}', ".join(f"""'"{k}"{colon}', {v}""" for k, v in pairs.items())
    return f"concat('{{', {parts}, '}}')"


# One line in 29 is cut short, one an array, one has a number for a text.
_TEXTS = {c: _json_text(c) for c in TICKET_FIELDS}
LINE = f"""CASE ticket_id % 29 WHEN 1 THEN '{{"Category": ' WHEN 2 THEN '[1,2]'
    WHEN 3 THEN '{{"Category":5}}' WHEN 4 THEN '  '
    ELSE {_json_object(_TEXTS)} END"""
# The same objects as a strict re-dump writes them; null for the other lines.
REDUMPED = f"""CASE WHEN ticket_id % 29 = 3 THEN '{{"Category": 5}}'
    WHEN ticket_id % 29 NOT IN (1, 2, 4) THEN {_json_object(_TEXTS, ": ", ", ")} END"""

_PAIR = {
    "instruction": """concat('"', Description, '"')""",
    "response": """concat('"', coalesce(Close_Notes, 'unknown'), '"')""",
    "category": """concat('"', Category, '"')""",
    "subcategory": """concat('"', Subcategory, '"')""",
    "assignment_group": """concat('"', coalesce(Assignment_Group, 'unknown'), '"')""",
}


def _answer(data: str, status: str = "good") -> str:
    return f"""concat('{{"status":"{status}","data":', {data}, '}}')"""


RESPONSE = f"""CASE ticket_id % 7
    WHEN 0 THEN {_answer(_json_object(_PAIR))}
    WHEN 1 THEN '{{"status":"bad","data":"corrupt"}}'
    WHEN 2 THEN '{{"status":"bad","data":""}}'
    WHEN 3 THEN {_answer(_json_object({**_PAIR, "extra": "1"}))}
    WHEN 4 THEN {_answer(_json_object({k: v for k, v in _PAIR.items() if k != "category"}))}
    WHEN 5 THEN {_answer("'\"all fine\"'")}
    ELSE '{{"status":"fine","data":"?"}}' END"""

ANSWER_COLUMNS = {
    "value": LINE,
    "response": f"CASE WHEN ticket_id % 19 = 0 THEN NULL ELSE {RESPONSE} END",
    "refusal": "CASE WHEN ticket_id % 23 = 0 THEN 'I cannot help with that' END",
    "call_class": """CASE ticket_id % 50 WHEN 7 THEN 'api_error' WHEN 8 THEN 'breaker_open'
        WHEN 9 THEN 'rate_limited' WHEN 10 THEN 'unexpected' END""",
    "call_error": "CASE ticket_id % 50 WHEN 7 THEN 'rate limit' WHEN 10 THEN 'lost worker' END",
    "seconds": "(ticket_id % 2000) / 10.0",
}

# Event properties spoilt in the ways a strict reader must tell apart.
SPOILT = """CASE event_id % 9 WHEN 1 THEN '' WHEN 2 THEN concat(props, ' x')
    WHEN 3 THEN concat('{', chr(39), 'k', chr(39), ':1}') WHEN 4 THEN '{"a":1,"a":2}'
    WHEN 5 THEN '[1,2]' WHEN 6 THEN '   ' WHEN 7 THEN '{"b":1,"a":2.0}' WHEN 8 THEN '{"a":1,}'
    ELSE props END"""


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    orders = spread(table(spark, folder, "orders"))
    customers = table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in TICKET_COLUMNS.items()])


def answered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ticket lines with the log of their model call."""
    return tickets(spark, folder).selectExpr(
        "ticket_id", *[f"{e} AS {n}" for n, e in ANSWER_COLUMNS.items()]
    )


def spoilt_lines(spark: SparkSession, folder: str) -> DataFrame:
    events = spread(table(spark, folder, "events").select("event_id", "user_id", "props"))
    return events.selectExpr("event_id", "user_id", f"{SPOILT} AS value")


def pairs(spark: SparkSession, folder: str, measure: Column) -> DataFrame:
    """``measure`` of a user turn and of the assistant turn right after it.

    Joined on the turn as well, so a long conversation is no single key.
    """
    turns = table(spark, folder, "conversations").withColumn("measure", measure)
    asked = turns.filter("role = 'user'").selectExpr("conv_id", "turn", "measure AS instruction")
    said = turns.filter("role = 'assistant'").selectExpr("conv_id", "turn - 1 AS turn", "measure AS response")
    return asked.join(said, ["conv_id", "turn"])


TICKETS_SQL = f"""tickets AS (SELECT {_listed(TICKET_COLUMNS)}
    FROM orders JOIN customer ON o_custkey = c_custkey)"""
ANSWERS_SQL = f"{TICKETS_SQL}, answers AS (SELECT ticket_id, {_listed(ANSWER_COLUMNS)} FROM tickets)"
SPOILT_SQL = f"lines AS (SELECT event_id, user_id, {SPOILT} AS value FROM events)"
PAIRS_SQL = """pairs AS (SELECT a.conv_id, a.turn, a.text AS instruction, b.text AS response
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user' AND b.role = 'assistant')"""
