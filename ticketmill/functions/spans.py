"""Find, resolve and replace spans as JVM expressions.

A span is ``struct<start:int, end:int, entity:string, score:double>`` with
offsets in characters of the original text. Everything here is a Column built
from Spark functions, so it stays in the JVM; `functions.span_udfs` has the
Arrow twin for wide detector sets and long texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .detectors import Detector, is_plain, operators_for

SPAN = "struct<start:int,end:int,entity:string,score:double>"
SPANS = f"array<{SPAN}>"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hint_test(text: Column, detectors: Iterable[Detector]) -> Column:
    """True for every text in which one of the detectors can match."""
    test = F.lit(False)
    for d in detectors:
        if d.hint is None:
            return F.lit(True)
        found = F.contains(text, F.lit(d.hint)) if is_plain(d.hint) else text.rlike(d.hint)
        test = test | found
    return test


def passes_luhn(hit: Column) -> Column:
    """Luhn checksum over the digits of a short match."""
    digits = F.split(F.reverse(F.regexp_replace(hit, "[^0-9]", "")), "")

    def weigh(d: Column, i: Column) -> Column:
        n = d.try_cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    total = F.aggregate(
        F.transform(digits, weigh), F.lit(0), lambda acc, n: acc + F.coalesce(n, F.lit(0))
    )
    return total % 10 == 0


def _detector_spans(text: Column, d: Detector) -> Column:
    """Gaps and matches alternate; running sums of their lengths are offsets."""
    hits = F.regexp_extract_all(text, F.lit(d.pattern), F.lit(0))
    gaps = F.split(text, d.pattern, -1)
    keep = passes_luhn if d.check == "luhn" else (lambda h: F.lit(True))
    pieces = F.zip_with(
        hits,
        gaps,
        lambda h, g: F.struct(
            F.length(g).alias("gap"),
            F.coalesce(F.length(h), F.lit(0)).alias("hit"),
            (h.isNotNull() & keep(h)).alias("keep"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

    def add(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        span = F.struct(
            begin.alias("start"),
            (begin + p["hit"]).alias("end"),
            F.lit(d.entity).alias("entity"),
            F.lit(float(d.score)).alias("score"),
        )
        return F.struct(
            (begin + p["hit"]).alias("at"),
            F.when(p["keep"], F.concat(acc["found"], F.array(span)))
            .otherwise(acc["found"])
            .alias("found"),
        )

    found = F.aggregate(pieces, start, add, lambda acc: acc["found"])
    return F.when(hint_test(text, [d]), found).otherwise(F.array().cast(SPANS))


def find_spans(text: Column, detectors: Iterable[Detector]) -> Column:
    """Spans of every detector over the original text, overlaps included."""
    return F.flatten(F.array(*[_detector_spans(text, d) for d in detectors]))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _greedy(cluster: Column) -> Column:
    """Best span first; a span is kept if it touches no better one."""
    ranked = F.array_sort(
        F.transform(
            cluster,
            lambda s: F.struct(
                (-s["score"]).alias("cost"),
                (s["start"] - s["end"]).alias("shortness"),
                s["start"].alias("start"),
                s["entity"].alias("name"),
                s.alias("span"),
            ),
        )
    )
    return F.aggregate(
        F.transform(ranked, lambda r: r["span"]),
        F.array().cast(SPANS),
        lambda kept, s: F.when(F.exists(kept, lambda k: _overlaps(k, s)), kept).otherwise(
            F.concat(kept, F.array(s))
        ),
    )


def resolve_spans(spans: Column) -> Column:
    """A non-overlapping subset in text order.

    Higher score wins, then the longer span, then the earlier one, then the
    entity name. Spans only compete inside a cluster of touching spans, so the
    pairwise test never runs over a whole document.
    """
    return bind(spans, lambda s: F.when(F.size(s) < 2, s).otherwise(_resolve_many(s)))


def _resolve_many(spans: Column) -> Column:
    ordered = F.array_sort(spans)
    clusters_type = f"array<{SPANS}>"
    start = F.struct(
        F.array().cast(clusters_type).alias("done"),
        F.array().cast(SPANS).alias("open"),
        F.lit(0).alias("reach"),
    )

    def add(acc: Column, s: Column) -> Column:
        joins = s["start"] < acc["reach"]
        return F.struct(
            F.when(joins | (F.size(acc["open"]) == 0), acc["done"])
            .otherwise(F.concat(acc["done"], F.array(acc["open"])))
            .alias("done"),
            F.when(joins, F.concat(acc["open"], F.array(s))).otherwise(F.array(s)).alias("open"),
            F.greatest(acc["reach"], s["end"]).alias("reach"),
        )

    clusters = F.aggregate(
        ordered, start, add, lambda acc: F.concat(acc["done"], F.array(acc["open"]))
    )
    resolved = F.flatten(
        F.transform(clusters, lambda c: F.when(F.size(c) < 2, c).otherwise(_greedy(c)))
    )
    return F.array_sort(resolved)


def operator_lookup(operators: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(operators.items()) for x in kv])


def replace_spans(text: Column, spans: Column, operators: dict[str, str] | None = None) -> Column:
    """The text with every (non-overlapping, ordered) span replaced."""
    table = operators_for(operators)
    lookup = operator_lookup(table)
    fallback = F.lit(table["DEFAULT"])

    def piece(all_spans: Column, s: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(0)).otherwise(F.get(all_spans, i - 1)["end"])
        return F.concat(
            F.substring(text, before + 1, s["start"] - before),
            F.coalesce(F.try_element_at(lookup, s["entity"]), fallback),
        )

    def rebuilt(all_spans: Column) -> Column:
        tail = F.element_at(all_spans, -1)["end"]
        return F.concat(
            F.array_join(F.transform(all_spans, lambda s, i: piece(all_spans, s, i)), ""),
            F.substring(text, tail + 1, F.length(text)),
        )

    return bind(spans, lambda s: F.when(F.size(s) > 0, rebuilt(s)).otherwise(text))


def redact_text(
    text: Column, detectors: Iterable[Detector], operators: dict[str, str] | None = None
) -> Column:
    """Find, resolve and replace in one expression; null and empty pass through."""
    detectors = tuple(detectors)

    spans = resolve_spans(find_spans(text, detectors))
    work = replace_spans(text, spans, operators)
    return F.when(hint_test(text, detectors), work).otherwise(text)
