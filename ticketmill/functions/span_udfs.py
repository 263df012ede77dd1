"""Arrow twins of `functions.spans` for wide detector sets and long texts.

Higher-order functions are interpreted, so many detectors or thousands of
matches per text are cheaper in one Arrow batch function. The functions below
are per-text helpers; Spark partitions the texts and calls them per batch.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .detectors import Detector, is_plain, operators_for
from .jsonl import once
from .spans import SPANS, hint_test
from .text import python_pattern

CONTEXT_WINDOW = 5  # word runs looked at on either side of a span
CONTEXT_BOOST = 0.35

_WORDS = re.compile(r"\w+")
_ARROW_SPAN = pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("entity", pa.string()), ("score", pa.float64())]
)


def span_lists(found: Iterable[list[tuple] | None]) -> pa.ListArray:
    """Lists of (start, end, entity, score) as an Arrow column; None becomes null."""
    flat: list[tuple] = []
    offsets: list[int | None] = []
    for spans in found:
        offsets.append(None if spans is None else len(flat))
        flat.extend(spans or ())
    offsets.append(len(flat))
    columns = list(zip(*flat)) if flat else [[], [], [], []]
    values = pa.StructArray.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW_SPAN)], fields=list(_ARROW_SPAN)
    )
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), values)


def _luhn(hit: str) -> bool:
    digits = [int(c) for c in reversed(hit) if c.isdigit()]
    doubled = (2 * d if i % 2 else d for i, d in enumerate(digits))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _any_hint(detectors: tuple[Detector, ...]):
    """The hint test of `spans.hint_test` for a text inside a task."""
    if any(d.hint is None for d in detectors):
        return lambda text: True
    hints = (re.escape(d.hint) if is_plain(d.hint) else python_pattern(d.hint) for d in detectors)
    return re.compile("|".join(f"(?:{h})" for h in hints)).search


def _compiled(detectors: Iterable[Detector]) -> list[tuple]:
    return [
        (
            d.entity,
            re.compile(python_pattern(d.pattern)),
            d.score,
            d.check,
            [tuple(_WORDS.findall(term.lower())) for term in d.context],
            _any_hint((d,)),
        )
        for d in detectors
    ]


def _near_context(words: list, starts: list[int], begin: int, end: int, terms: list) -> bool:
    """Does a context term stand within the window before or after the span?"""
    first = bisect_left(starts, begin)
    after = bisect_left(starts, end)
    for run in (words[max(0, first - CONTEXT_WINDOW) : first], words[after : after + CONTEXT_WINDOW]):
        for term in terms:
            n = len(term)
            if any(tuple(run[i : i + n]) == term for i in range(len(run) - n + 1)):
                return True
    return False


def _find(text: str, compiled: list[tuple], context: bool) -> list[tuple]:
    words = starts = None
    found = []
    for entity, pattern, score, check, terms, possible in compiled:
        if not possible(text):
            continue
        for m in pattern.finditer(text):
            if check == "luhn" and not _luhn(m.group()):
                continue
            value = score
            if context and terms:
                if words is None:
                    runs = list(_WORDS.finditer(text))
                    words = [r.group().lower() for r in runs]
                    starts = [r.start() for r in runs]
                if _near_context(words, starts, m.start(), m.end(), terms):
                    value = min(1.0, score + CONTEXT_BOOST)
            found.append((m.start(), m.end(), entity, value))
    return found


def _resolve(found: list[tuple]) -> list[tuple]:
    """Same policy as `spans.resolve_spans`: kept spans stay sorted by start."""
    if len(found) < 2:
        return found
    kept: list[tuple] = []
    for span in sorted(found, key=lambda s: (-s[3], s[0] - s[1], s[0], s[2])):
        at = bisect_left(kept, span)
        if at > 0 and kept[at - 1][1] > span[0]:
            continue
        if at < len(kept) and kept[at][0] < span[1]:
            continue
        kept.insert(at, span)
    return kept


def _replace(text: str, kept: list[tuple], operators: dict[str, str]) -> str:
    out, at = [], 0
    for begin, end, entity, _ in kept:
        out.append(text[at:begin])
        out.append(operators.get(entity, operators["DEFAULT"]))
        at = end
    out.append(text[at:])
    return "".join(out)


def _gated(text: Column, detectors: tuple[Detector, ...]) -> Column:
    """Null for texts no detector can match: they never cross to Python.

    Broken UTF-8 cannot cross either; its bad bytes are replaced first.
    """
    return F.when(hint_test(text, detectors), F.make_valid_utf8(text))


def find_spans(
    text: Column, detectors: Iterable[Detector], context: bool = False, resolved: bool = False
) -> Column:
    detectors = tuple(detectors)

    @F.arrow_udf(SPANS)
    def analyse(texts: pa.Array) -> pa.Array:
        compiled = _compiled(detectors)
        pick = _resolve if resolved else list
        return span_lists(
            None if t is None else pick(_find(t, compiled, context)) for t in texts.to_pylist()
        )

    return F.coalesce(once(analyse)(_gated(text, detectors)), F.array().cast(SPANS))


def make_redactor(detectors: tuple[Detector, ...], operators: dict[str, str], context: bool, memo: int):
    """text -> redacted text. The memo is keyed on the whole text."""
    compiled = _compiled(detectors)

    def redact(text: str) -> str:
        return _replace(text, _resolve(_find(text, compiled, context)), operators)

    return lru_cache(maxsize=memo)(redact) if memo else redact


# Fixed value: how a text that could not be redacted begins.
MARKER = "<REDACTION_ERROR: "


def _marker(error: Exception) -> str:
    # Only the kind of failure: the message could repeat the text.
    return f"{MARKER}{type(error).__name__}>"


def redact_text(
    text: Column,
    detectors: Iterable[Detector],
    operators: dict[str, str] | None = None,
    context: bool = False,
    memo: int = 0,
) -> Column:
    detectors = tuple(detectors)
    table = operators_for(operators)
    state: dict = {}

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        # One redactor per task, so the memo lives across batches.
        run = state.get("run") or state.setdefault(
            "run", make_redactor(detectors, table, context, memo)
        )
        out = []
        for t in texts.to_pylist():
            try:
                out.append(None if t is None else run(t))
            except Exception as error:  # one bad text must not lose the record
                out.append(_marker(error))
        return pa.array(out, type=pa.string())

    return F.coalesce(redact(_gated(text, detectors)), text)


# Why a line has no redacted record.
REJECTS = ("missing", "invalid_unicode", "invalid_json", "not_an_object", "too_deep")
REDACTED_JSON = "struct<value:string,reject:string>"


def _walk_strings(record: dict, deep: bool, change: Callable[[str], str]) -> None:
    """Change the strings of a record in place; nesting of any depth."""
    waiting: list = [record]
    while waiting:
        value = waiting.pop()
        for at, item in value.items() if isinstance(value, dict) else enumerate(value):
            if isinstance(item, str):
                value[at] = change(item)
            elif deep and isinstance(item, (dict, list)):
                waiting.append(item)


def redact_json(
    line: Column,
    detectors: Iterable[Detector],
    operators: dict[str, str] | None = None,
    deep: bool = False,
) -> Column:
    """Redact the strings of a JSON object line: ``value``, or ``reject`` with one of REJECTS.

    Only top-level fields by default; ``deep`` also visits nested objects and arrays.
    Other values are kept as they are. No line fails the job.
    """
    detectors = tuple(detectors)
    table = operators_for(operators)
    kind = pa.struct([("value", pa.string()), ("reject", pa.string())])

    @F.arrow_udf(REDACTED_JSON)
    def redact(lines: pa.Array) -> pa.Array:
        run = make_redactor(detectors, table, False, 0)
        candidate = _any_hint(detectors)

        def change(text: str) -> str:
            if not candidate(text):
                return text
            try:
                return run(text)
            except Exception as error:  # one bad text must not lose the record
                return _marker(error)

        def one(text: str) -> tuple[str | None, str | None]:
            try:
                record = json.loads(text)
            except RecursionError:
                return None, "too_deep"
            except ValueError:
                return None, "invalid_json"
            if not isinstance(record, dict):
                return None, "not_an_object"
            try:
                _walk_strings(record, deep, change)
                dumped = json.dumps(record, ensure_ascii=False)
                dumped.encode("utf-8")
            except RecursionError:
                return None, "too_deep"
            except UnicodeEncodeError:  # an escape that is half of a character
                return None, "invalid_unicode"
            return dumped, None

        rows = [(None, None) if t is None else one(t) for t in lines.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], type=pa.string()) for i in range(2)], fields=list(kind)
        )

    done = once(redact)(F.when(F.is_valid_utf8(line), line))
    unread = F.when(line.isNull(), "missing").when(~F.is_valid_utf8(line), "invalid_unicode")
    return F.struct(done["value"].alias("value"), F.coalesce(unread, done["reject"]).alias("reject"))
