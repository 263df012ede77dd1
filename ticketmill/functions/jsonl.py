"""Strict JSON lines: the verdict, the canonical form, and shape checks.

Spark's JSON readers accept lines a strict decoder rejects (trailing text,
single quotes) and reject lines it accepts (duplicate keys, NaN), so the
verdict comes from the standard decoder in Arrow batches. Blank lines are
recognised in the JVM and never cross to Python.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank

VERDICT = (
    "struct<verdict:string,kind:string,line:string,reason:string,"
    "shape_ok:boolean,fields:map<string,string>>"
)
_ARROW_VERDICT = pa.struct(
    [(n, pa.string()) for n in ("verdict", "kind", "line", "reason")]
    + [("shape_ok", pa.bool_()), ("fields", pa.map_(pa.string(), pa.string()))]
)

_SURROGATE = re.compile(r"\\u[dD][89a-fA-F]")
_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}


def _reject_constant(name: str) -> float:
    raise ValueError(f"{name} is not JSON")


def struct_array(rows: list[dict | None], kind: pa.StructType) -> pa.StructArray:
    """Column by column: much faster than converting a list of dicts."""
    columns = [
        pa.array([None if r is None else r.get(field.name) for r in rows], type=field.type)
        for field in kind
    ]
    missing = pa.array([r is None for r in rows], type=pa.bool_())
    return pa.StructArray.from_arrays(columns, fields=list(kind), mask=missing)


def _writable(line: str, value, dump: bool) -> str | None:
    """The value on one line, as far as ``dump`` asks for it; fails on half a character.

    Only an escape can bring one in, so other lines need no encoding to find out.
    """
    escaped = _SURROGATE.search(line) is not None
    if not (dump or escaped):
        return None
    dumped = json.dumps(value, ensure_ascii=False)
    if escaped:
        dumped.encode("utf-8")
    return dumped


def _judge(line: str, allow_nan: bool, fields: tuple[str, ...], dump: bool) -> dict:
    try:
        value = json.loads(line, parse_constant=float if allow_nan else _reject_constant)
        dumped = _writable(line, value, dump)
    except UnicodeEncodeError:
        return {"verdict": "invalid_unicode", "reason": "Invalid JSON: lone surrogate"}
    except json.JSONDecodeError as error:
        return {"verdict": "invalid", "reason": f"Invalid JSON: {error}"}
    except (ValueError, RecursionError) as error:
        return {"verdict": "invalid", "reason": f"Invalid JSON: {type(error).__name__}"}
    row = {"verdict": "ok", "kind": _KINDS.get(type(value), "number"), "line": dumped if dump else None}
    if fields:
        picked = {f: value.get(f) for f in fields} if isinstance(value, dict) else {}
        texts = all(v is None or isinstance(v, str) for v in picked.values())
        row["shape_ok"] = isinstance(value, dict) and texts
        row["fields"] = list(picked.items()) if row["shape_ok"] else None
    return row


def once(udf):
    """Evaluate a decoding UDF once per row.

    Its result is nearly always filtered on, and Catalyst would push such a
    filter below the projection and call the function a second time. A function
    it takes for nondeterministic stays where it is. Filter on other columns
    before decoding: they are not pushed past it either.
    """
    return udf.asNondeterministic()


def strict_json(text: str):
    """The decoded value; None when a strict reader rejects the text."""
    try:
        value = json.loads(text.strip())
        _writable(text, value, False)
    except (ValueError, RecursionError):
        return None
    return value


def json_verdict(
    line: Column,
    allow_nan: bool = True,
    fields: tuple[str, ...] = (),
    strip_line: bool = True,
    dump: bool = True,
) -> Column:
    """``verdict`` ok / blank / invalid / invalid_unicode, the ``kind`` of value,
    the compact one-line ``line`` and, for rejects, the ``reason``. Without ``dump``
    ``line`` is null, which saves writing every value anew.

    Without ``strip_line``, white space that JSON does not know (a no-break
    space, say) around the value makes the line invalid.

    With ``fields``, ``shape_ok`` tells whether the line is an object in which
    each named field is a string, null or missing, and ``fields`` has them.
    """

    @F.arrow_udf(VERDICT)
    def judge(lines: pa.Array) -> pa.Array:
        texts = (t.strip() if t is not None and strip_line else t for t in lines.to_pylist())
        rows = [None if t is None else _judge(t, allow_nan, fields, dump) for t in texts]
        return struct_array(rows, _ARROW_VERDICT)

    blank = F.coalesce(is_blank(line), F.lit(True))
    readable = F.is_valid_utf8(line)

    def without_value(verdict: str, reason: Column) -> Column:
        nothing = F.lit(None)
        return F.struct(
            F.lit(verdict).alias("verdict"),
            nothing.cast("string").alias("kind"),
            nothing.cast("string").alias("line"),
            reason.cast("string").alias("reason"),
            nothing.cast("boolean").alias("shape_ok"),
            nothing.cast("map<string,string>").alias("fields"),
        )

    return F.coalesce(
        once(judge)(F.when(readable & ~blank, line)),
        F.when(~readable, without_value("invalid_unicode", F.lit("Invalid JSON: not UTF-8"))),
        without_value("blank", F.lit(None)),
    )
