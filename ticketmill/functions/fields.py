"""Ticket fields: cleaning, filling, payloads and training pairs."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .detectors import PHONE
from .text import strip

# The six ticket fields in output order, their export headers,
# the five fields of a finished ticket, and the filler for a missing field.
TICKET_FIELDS = (
    "Short_Description",
    "Description",
    "Close_Notes",
    "Category",
    "Subcategory",
    "Assignment_Group",
)
EXPORT_COLUMNS = {name: name.replace("_", " ") for name in TICKET_FIELDS}
GOOD_FIELDS = ("instruction", "response", "category", "subcategory", "assignment_group")
UNKNOWN = "unknown"

# Cell texts that a spreadsheet reader takes for "missing".
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def blank_to_null(text: Column, markers: Iterable[str] = ()) -> Column:
    """Stripped text; null when blank or, before stripping, a missing marker."""
    markers = list(markers)
    kept = F.when(~text.isin(*markers), text) if markers else text
    return F.nullif(strip(kept), F.lit(""))


def fill_missing(text: Column) -> Column:
    """Null becomes the filler; an empty text stays empty."""
    return F.coalesce(text, F.lit(UNKNOWN))


def six_fields(filled: bool = True) -> list[Column]:
    """The fixed projection; run it before anything opaque, so scans stay narrow."""
    return [(fill_missing(F.col(n)) if filled else F.col(n)).alias(n) for n in TICKET_FIELDS]


def payload() -> Column:
    """Compact JSON of the six filled fields, non-ASCII unescaped."""
    return F.to_json(F.struct(*six_fields()))


# Lines that carry no instruction. A signature marker also ends the text.
_SIGNATURE = (
    r"(?i)^\s*(--\s*$|(best |kind |warm )?regards\b|thanks[,.!]?\s*$|thank you[,.!]?\s*$"
    r"|sincerely\b|cheers[,.]?\s*$|sent from my )"
)
_DISCLAIMER = (
    r"(?i)(this (e-?mail|message)( and any attachments)? (is|are|may)\b|confidentiality notice"
    r"|intended recipient|^\s*disclaimer\b)"
)


# Any of these words stands in every line the two patterns match.
_SUSPECT = (
    r"(?i)--|regards|thank|sincerely|cheers|sent from my|this e-?mail|this message"
    r"|confidentiality|recipient|disclaimer"
)


def remove_boilerplate(text: Column) -> Column:
    """Drop disclaimer lines, and everything from a signature line on."""
    lines = F.split(text, r"\r\n|\r|\n", -1)
    first = F.array_position(F.transform(lines, lambda x: x.rlike(_SIGNATURE)), True)
    body = F.when(first > 0, F.slice(lines, 1, (first - 1).cast("int"))).otherwise(lines)
    kept = F.filter(body, lambda x: ~x.rlike(_DISCLAIMER))
    # Most texts have neither, and skip the line work.
    return F.when(text.rlike(_SUSPECT), F.array_join(kept, "\n")).otherwise(text)


def remove_phones(text: Column) -> Column:
    return F.when(text.rlike(PHONE.hint), F.regexp_replace(text, PHONE.pattern, "")).otherwise(text)


def collapse_space(text: Column) -> Column:
    return strip(F.regexp_replace(text, "[ \t]+", " "))


def leading_sentences(text: Column, count: int) -> Column:
    """The first sentences: an extract that stands in for a summary."""
    ends = r"(?<=[.!?])\s+"
    return F.array_join(F.slice(F.split(text, ends, -1), 1, count), " ")


def training_pairs(df: DataFrame, keep: Iterable[str] = (), sentences: int = 3) -> DataFrame:
    """Rule-based pairs from the six fields: instruction, response, categories.

    In stages: each step reads its input several times, and Spark evaluates a
    costly column of an earlier stage only once.
    """
    merged = F.concat_ws(
        " ", blank_to_null(F.col("Short_Description")), blank_to_null(F.col("Description"))
    )
    texts = {"instruction": merged, "response": F.coalesce(blank_to_null(F.col("Close_Notes")), F.lit(""))}
    out = df.withColumns(texts)
    for step in (remove_boilerplate, remove_phones, collapse_space):
        out = out.withColumns({name: step(F.col(name)) for name in texts})
    return out.select(
        *keep,
        "instruction",
        leading_sentences(F.col("response"), sentences).alias("response"),
        fill_missing(F.col("Category")).alias("category"),
        fill_missing(F.col("Subcategory")).alias("subcategory"),
        fill_missing(F.col("Assignment_Group")).alias("assignment_group"),
    )


DEFAULT_PROMPT = (
    "Turn the service ticket in the user message into a training pair. Merge the short "
    "description and the description into an instruction without phone numbers, disclaimers "
    "and signatures; summarise the close notes as the response; keep the categories. Answer "
    'with JSON holding "status" (good or bad) and "data" (the pair, or why it is bad).'
)


def response_schema() -> dict:
    """JSON schema of the answer a model must give."""
    pair = {
        "type": "object",
        "properties": {name: {"type": "string"} for name in GOOD_FIELDS},
        "required": list(GOOD_FIELDS),
        "additionalProperties": False,
    }
    return {
        "type": "object",
        "properties": {
            "status": {"type": "string", "enum": ["good", "bad"]},
            "data": {"anyOf": [pair, {"type": "string"}]},
        },
        "required": ["status", "data"],
        "additionalProperties": False,
    }


def model_request(
    user_text: Column,
    model: str,
    prompt: str = DEFAULT_PROMPT,
    max_tokens: int = 1000,
    temperature: float = 0.0,
) -> Column:
    """One batch-request line per row; nothing is sent anywhere."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    body = F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message("system", F.lit(prompt)), message("user", user_text)).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )
    )
    schema = json.dumps(response_schema(), separators=(",", ":"))
    # The schema is a constant, spliced in as text instead of built per row.
    return F.concat(
        F.substring(body, F.lit(1), F.length(body) - 1), F.lit(f',"response_format":{schema}}}')
    )
