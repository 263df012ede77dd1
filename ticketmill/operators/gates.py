"""Gates between a raw ticket and a training pair, and the routing verdict.

Every gate is a condition with a text; the first one in `REASON_ORDER` that
holds decides, and a row that passes all of them is good.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import GOOD_FIELDS, TICKET_FIELDS, payload
from ..functions.jsonl import json_verdict, once, strict_json, struct_array
from ..functions.text import word_count

# Texts of the reasons a ticket is bad.
BREAKER_OPEN = "Circuit breaker open (requests not allowed)"
RATE_LIMITED = "Shutdown requested mid-rate-limit"
REFUSED = "Failed to parse LLM response"
NO_REASON = "LLM says BAD with no reason"
SCHEMA_ERROR = "TicketSchema validation error"
NO_DATA = "No parsed data in LLM response"
TOO_SHORT = "Instruction or response too short"
# Shortest accepted text in words, longest processing in seconds.
MIN_WORDS = 5
TIMEOUT_SECONDS = 180

REASON_ORDER = (
    "timeout",
    "invalid_json",
    "invalid_unicode",
    "invalid_shape",
    "rate_limited",
    "breaker_open",
    "refusal",
    "api_error",
    "unexpected",
    "model_bad",
    "schema_error",
    "no_data",
    "too_short",
)
# Error classes that count as failures for the circuit breaker (a refusal does not).
BREAKER_FAILURES = ("api_error", "unexpected")
TECHNICAL = ("api_error", "breaker_open", "unexpected", "timeout")


def raw_tickets(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines as six nullable fields, plus the verdict and ``shape_ok``.

    The source line is kept verbatim as ``raw_ticket``.
    """
    judged = lines.withColumn("json", json_verdict(F.col(column), fields=TICKET_FIELDS, dump=False))
    fields = {n: F.try_element_at(F.col("json.fields"), F.lit(n)) for n in TICKET_FIELDS}
    shape = F.coalesce("json.shape_ok", F.lit(False))
    return judged.withColumns(
        {**fields, "raw_ticket": F.col(column), "shape_ok": shape}
    ).withColumn("request_payload", F.when(F.col("shape_ok"), payload()))


_ANSWER = (
    "struct<valid:boolean,status:string,reason:string,object:boolean,"
    f"ticket:struct<{','.join(f'{n}:string' for n in GOOD_FIELDS)}>>"
)
_ARROW_ANSWER = pa.struct(
    [
        ("valid", pa.bool_()),
        ("status", pa.string()),
        ("reason", pa.string()),
        ("object", pa.bool_()),
        ("ticket", pa.struct([(n, pa.string()) for n in GOOD_FIELDS])),
    ]
)


def _read_answer(text: str) -> dict:
    answer = strict_json(text)
    answer = answer if isinstance(answer, dict) else {}
    status, data = answer.get("status"), answer.get("data")
    is_object = isinstance(data, dict)
    pair_ok = (
        is_object
        and data.keys() == set(GOOD_FIELDS)
        and all(isinstance(v, str) for v in data.values())
    )
    return {
        "valid": answer.keys() == {"status", "data"}
        and status in ("good", "bad")
        and isinstance(data, (dict, str)),
        "status": status if isinstance(status, str) else None,
        "reason": json.dumps(data, ensure_ascii=False) if is_object else data if isinstance(data, str) else None,
        "object": is_object,
        "ticket": data if pair_ok else None,
    }


def parse_response(response: Column) -> Column:
    """Read a model answer strictly.

    ``valid`` is false unless the answer is an object with exactly ``status``
    (good or bad) and ``data`` (object or string). ``reason`` is the string data
    or the JSON text of an object, ``object`` tells which, and ``ticket`` holds
    the five strings when ``data`` has exactly these. One Arrow function, as
    strictness needs the standard decoder anyway.
    """

    @F.arrow_udf(_ANSWER)
    def read(answers: pa.Array) -> pa.Array:
        rows = [None if t is None else _read_answer(t) for t in answers.to_pylist()]
        return struct_array(rows, _ARROW_ANSWER)

    return once(read)(F.when(F.is_valid_utf8(response), response))


def too_few_words(counts: Iterable[Column], min_words: int = MIN_WORDS) -> Column:
    if min_words < 0:
        raise ValueError("min_words must not be negative")
    return F.least(*[F.coalesce(c, F.lit(0)) for c in counts]) < min_words


def too_short(instruction: Column, response: Column, min_words: int = MIN_WORDS) -> Column:
    return too_few_words([word_count(instruction), word_count(response)], min_words)


def timeout_reason(seconds: Column, limit: float = TIMEOUT_SECONDS) -> Column:
    text = F.concat(F.lit("Ticket timed out after "), F.floor(seconds).cast("string"), F.lit("s"))
    return F.when(seconds > limit, text)


def classify(
    df: DataFrame,
    response: str = "response",
    refusal: str | None = None,
    call_error: str | None = None,
    call_class: str | None = None,
    seconds: str | None = None,
    min_words: int = MIN_WORDS,
    timeout: float = TIMEOUT_SECONDS,
) -> DataFrame:
    """Route raw tickets (see `raw_tickets`) with their model answers.

    Optional log columns: ``refusal`` text, ``call_class`` (rate_limited,
    breaker_open, api_error or unexpected) with its ``call_error`` text, and the
    processing time in ``seconds``. Adds ``status``, ``error_class``, ``error``
    and ``ticket``; nothing is dropped, so good and bad add up to the input.
    """

    def optional(name: str | None) -> Column:
        return F.col(name) if name else F.lit(None).cast("string")

    answer, verdict, ticket = F.col("answer"), F.col("json.verdict"), F.col("answer.ticket")
    logged, call_text = optional(call_class), F.coalesce(optional(call_error), F.lit(""))
    refused = (F.coalesce(optional(refusal), F.lit("")) != "") | F.col(response).isNull()
    # Only a returned answer can be refused or judged.
    returned = logged.isNull()
    late = F.col(seconds) > timeout if seconds else F.lit(False)

    # In the order that decides; a condition is only evaluated when none before
    # it held, so the word counts run for the last few candidates only.
    conditions = {
        "timeout": late,
        "invalid_json": verdict.isin("invalid", "blank"),
        "invalid_unicode": verdict == "invalid_unicode",
        "invalid_shape": ~F.col("shape_ok"),
        "rate_limited": logged == "rate_limited",
        "breaker_open": logged == "breaker_open",
        "refusal": returned & refused,
        "api_error": logged == "api_error",
        "unexpected": (logged == "unexpected") | ~F.coalesce(answer["valid"], F.lit(False)),
        "model_bad": F.lower(answer["status"]) == "bad",
        "schema_error": answer["object"] & ticket.isNull(),
        "no_data": ~answer["object"],
        "too_short": too_short(ticket["instruction"], ticket["response"], min_words),
    }
    texts = {
        "timeout": timeout_reason(F.col(seconds), timeout) if seconds else F.lit(None),
        "invalid_json": F.coalesce("json.reason", F.lit("Invalid JSON: blank line")),
        "invalid_unicode": F.col("json.reason"),
        "invalid_shape": F.lit("Ticket is not an object with six text fields"),
        "rate_limited": F.lit(RATE_LIMITED),
        "breaker_open": F.lit(BREAKER_OPEN),
        "refusal": F.lit(REFUSED),
        "api_error": F.concat(F.lit("API Error (final): "), call_text),
        "unexpected": F.concat(
            F.lit("Worker unexpected final fail: "),
            F.when(returned, "answer does not match the response schema").otherwise(call_text),
        ),
        "model_bad": F.coalesce(F.nullif(answer["reason"], F.lit("")), F.lit(NO_REASON)),
        "schema_error": F.lit(SCHEMA_ERROR),
        "no_data": F.lit(NO_DATA),
        "too_short": F.lit(TOO_SHORT),
    }
    name = F.coalesce(*[F.when(conditions[n], F.lit(n)) for n in REASON_ORDER])
    error_class = F.col("error_class")
    text = F.coalesce(*[F.when(error_class == n, texts[n]) for n in REASON_ORDER])
    judged = df.withColumn("answer", parse_response(F.col(response))).withColumn("error_class", name)
    return judged.withColumns(
        {
            "status": F.when(error_class.isNull(), "good").otherwise("bad"),
            "error": text,
            "ticket": F.when(error_class.isNull(), ticket),
            # A transaction exists for every answer that came back, good or bad. A call whose
            # answer breaks the response schema fails, unless it is a refusal, and leaves none.
            "answered": F.coalesce(
                returned
                & F.col("shape_ok")
                & (verdict == "ok")
                & F.col(response).isNotNull()
                & ((F.coalesce(optional(refusal), F.lit("")) != "") | F.coalesce(answer["valid"], F.lit(False))),
                F.lit(False),
            ),
        }
    ).drop("answer")


def with_model(
    df: DataFrame,
    model_fn: Callable[[pd.Series], pd.Series],
    request: str = "request_payload",
    response: str = "response",
) -> DataFrame:
    """Run a caller's model over batches of requests: texts in, answer texts out.

    Each request is sent once: filters on the answer stay behind the call, and lines
    without a request (rejected ones) are not sent. An operator that reads its input
    twice needs the answers stored first. Put `repartition` before it to set how many
    run at once.
    """

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for requests in batches:
            answers = pd.Series([None] * len(requests), index=requests.index, dtype=object)
            asked = requests.notna()
            if asked.any():
                given = model_fn(requests[asked].reset_index(drop=True))
                if len(given) != asked.sum():
                    raise ValueError(f"{len(given)} answers to {asked.sum()} requests")
                answers[asked] = list(given)
            yield answers

    return df.withColumn(response, once(call)(F.col(request)))
