"""Redaction of DataFrames: which columns, which back end, which rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import span_udfs, spans
from ..functions.detectors import DEFAULT_DETECTORS, Detector, operators_for
from ..session import run_folder

# Above this many detectors the interpreted higher-order functions lose to one
# Arrow batch function; a detector that matches in nearly every text loses earlier.
NATIVE_LIMIT = 3
_FREQUENT = frozenset({"MACHINE_NAME"})


def pick_backend(detectors: Iterable[Detector], context: bool = False, memo: int = 0) -> str:
    detectors = tuple(detectors)
    wide = len(detectors) > NATIVE_LIMIT or any(d.entity in _FREQUENT for d in detectors)
    return "arrow" if context or memo or wide else "native"


def _backend(backend: str, detectors: tuple, context: bool = False, memo: int = 0) -> str:
    if backend == "auto":
        return pick_backend(detectors, context, memo)
    if backend not in ("native", "arrow"):
        raise ValueError(f"unknown backend {backend!r}")
    if backend == "native" and (context or memo):
        raise ValueError("context terms and the memo need the arrow backend")
    return backend


def analyze(
    text: Column,
    detectors: Iterable[Detector] = DEFAULT_DETECTORS,
    context: bool = False,
    backend: str = "auto",
    resolved: bool = False,
) -> Column:
    """All spans over the original text, or with ``resolved`` those that get replaced."""
    detectors = tuple(detectors)
    if _backend(backend, detectors, context) == "native":
        found = spans.find_spans(text, detectors)
        return spans.resolve_spans(found) if resolved else found
    return span_udfs.find_spans(text, detectors, context, resolved)


def redact(
    text: Column,
    detectors: Iterable[Detector] = DEFAULT_DETECTORS,
    operators: dict[str, str] | None = None,
    context: bool = False,
    memo: int = 0,
    backend: str = "auto",
) -> Column:
    detectors = tuple(detectors)
    if _backend(backend, detectors, context, memo) == "native":
        return spans.redact_text(text, detectors, operators)
    return span_udfs.redact_text(text, detectors, operators, context, memo)


def redact_spans(text: Column, found: Iterable[Column], operators: dict[str, str] | None = None) -> Column:
    """Redact spans from several sources at once: detectors, names, or a caller's
    own UDF that returns `functions.spans.SPANS`. Overlaps are resolved across them."""
    return spans.replace_spans(text, spans.resolve_spans(F.flatten(F.array(*found))), operators)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def redact_columns(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    detectors: Iterable[Detector] = DEFAULT_DETECTORS,
    operators: dict[str, str] | None = None,
    language: Column | None = None,
    languages: Iterable[str] = ("en",),
    **options,
) -> DataFrame:
    """Redact every top-level string column; other columns pass through.

    With a ``language`` column, rows in other languages are left untouched, and a
    detector that has a language is used for rows in it only.
    No shuffle: the rows stay in the partitions they were read into.
    """
    detectors = tuple(detectors)
    names = list(columns) if columns is not None else string_columns(df)
    own = sorted({d.language for d in detectors if d.language}) if language is not None else []

    def one(name: str) -> Column:
        text = F.col(name)
        if language is None:
            return redact(text, detectors, operators, **options)
        # A text reaches only the detectors of its row.
        general = tuple(d for d in detectors if d.language is None)
        cases = [(language == x, general + tuple(d for d in detectors if d.language == x)) for x in own if x in languages]
        cases.append((language.isin(*languages) & ~language.isin(*own), general) if own else (language.isin(*languages), general))
        chosen = text
        for when, used in reversed(cases):
            if used:
                chosen = F.when(when, redact(F.when(when, text), used, operators, **options)).otherwise(chosen)
        return chosen

    return df.withColumns({name: one(name) for name in names})


def failed_columns(columns: Iterable[str]) -> Column:
    """Names of the redacted columns that hold a failure marker instead of a text."""
    marked = [F.when(F.startswith(c, F.lit(span_udfs.MARKER)), F.lit(c)) for c in columns]
    return F.array_compact(F.array(*marked))


def redact_json_lines(
    df: DataFrame,
    column: str = "value",
    detectors: Iterable[Detector] = DEFAULT_DETECTORS,
    operators: dict[str, str] | None = None,
    deep: bool = False,
    reject: str = "reject",
) -> DataFrame:
    """Redact records with arbitrary keys, held as one JSON object per row.

    A line without a record becomes null, and ``reject`` tells why.
    """
    done = span_udfs.redact_json(F.col(column), detectors, operators, deep)
    kept = [c for c in df.columns if c != reject]
    out = df.select(*kept, done.alias("__json"))
    values = [F.col("__json.value").alias(c) if c == column else F.col(c) for c in kept]
    return out.select(*values, F.col("__json.reject").alias(reject))


def _sketched(counters: int):
    """Of each task: its rows (hash null), and a frequency sketch of their hashes.

    A sketch has ``counters`` values at most. When there are more, the count of the first
    one too many is taken off all: what is lost of a value is less than rows / counters,
    in a task and so over all of them.
    """

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            hashes = batch.column(0).drop_null().to_numpy()
            rows += batch.num_rows
            new, times = np.unique(hashes, return_counts=True)
            values, place = np.unique(np.concatenate([values, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times]), len(values)).astype(np.int64)
            if len(values) > counters:
                counts = counts - np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
                values, counts = values[counts > 0], counts[counts > 0]
        columns = [pa.array([None, *values.tolist()], pa.int64()), pa.array([rows, *counts.tolist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["__hash", "copies"])

    return sketched


def hot_values(df: DataFrame, value: Column, share: int) -> DataFrame:
    """Hashes of all values that fill more than 1/share of the rows, and of some that fill half as much.

    One pass, from which a task sends 2 * share counts at most. Only used to choose salts, so
    neither a hash collision nor a value too many costs results.
    """
    counters = 2 * share
    hashes = df.select(F.when(value.isNotNull(), F.xxhash64(value)).alias("h"))
    found = hashes.mapInArrow(_sketched(counters), "__hash long, copies long")
    folder = run_folder(df.sparkSession, "hot-values")
    found.groupBy("__hash").agg(F.sum("copies").alias("copies")).write.parquet(folder)
    counted = df.sparkSession.read.schema("__hash long, copies long").parquet(folder)
    rows = counted.filter("__hash IS NULL").agg(F.sum("copies")).first()[0] or 0
    return counted.filter(F.col("__hash").isNotNull() & (F.col("copies") > F.lit(rows / share - rows / counters))).select("__hash")


def redact_distinct(
    df: DataFrame,
    column: str,
    detectors: Iterable[Detector] = DEFAULT_DETECTORS,
    operators: dict[str, str] | None = None,
    salts: int = 32,
    share: int = 1000,
    **options,
) -> DataFrame:
    """Redact each distinct text once and join the result back on the text.

    Worth its two shuffles of the text only when texts repeat often and are
    costly to analyse; `redact(..., memo=n)` repeats no shuffle and is the
    cheaper memo otherwise. Rows no detector can touch skip the join. A text
    that fills more than 1/``share`` of the rows is spread over ``salts``
    tasks; there are fewer than ``share`` such texts, so that list is small.
    """
    detectors = tuple(detectors)
    text = F.col(column)
    candidate = F.coalesce(spans.hint_test(text, detectors), F.lit(False))
    rows, rest = df.filter(candidate), df.filter(~candidate)

    # Shares of all rows, though only rows with a candidate can be hot.
    hot = F.broadcast(hot_values(df, F.when(candidate, text), share))
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    # From the row's content and its partition: a retried task repeats the
    # salt, and even rows that are equal throughout are spread.
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    mixed = F.xxhash64(*[F.col(c) for c in plain], F.spark_partition_id())
    own_salt = F.pmod(mixed, F.lit(salts)).cast("int")

    def marked(frame: DataFrame) -> DataFrame:
        keyed = frame.withColumn("__hash", F.xxhash64(text))
        return keyed.join(hot.withColumn("__hot", F.lit(True)), "__hash", "left")

    unique = (
        marked(rows.select(column).distinct())
        .withColumn("__memo", redact(text, detectors, operators, **options))
        .withColumn(
            "__salt", F.explode(F.when(F.col("__hot"), every_salt).otherwise(F.array(F.lit(0))))
        )
        .select(column, "__salt", "__memo")
    )
    salted = marked(rows).withColumn("__salt", F.when(F.col("__hot"), own_salt).otherwise(F.lit(0)))
    joined = salted.join(unique, [column, "__salt"])
    redacted = joined.withColumn(column, F.col("__memo")).select(*df.columns)
    return redacted.unionByName(rest)


def entity_usage(found: DataFrame, column: str = "spans") -> DataFrame:
    """How often each entity was replaced."""
    return (
        found.select(F.explode(column).alias("span"))
        .groupBy(F.col("span.entity").alias("entity"))
        .agg(F.count("*").alias("uses"))
    )


def replacement_of(entity: Column, operators: dict[str, str] | None = None) -> Column:
    """Replacement for an entity; unknown entities get the DEFAULT one."""
    table = operators_for(operators)
    return F.coalesce(
        F.try_element_at(spans.operator_lookup(table), entity), F.lit(table["DEFAULT"])
    )
