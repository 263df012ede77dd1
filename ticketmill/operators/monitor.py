"""Run summaries, metrics and health: aggregates over the pipeline's own tables.

All of them combine map-side before their shuffle, and rankings keep only the
top rows of each partition before it, so a key that fills a third of the rows
moves as few bytes as any other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.detectors import Detector
from ..functions.jsonl import json_verdict
from ..functions.time import epoch_micros
from .gates import TECHNICAL

# Size of the recent-bad buffer, rows of it in a digest, and the
# limits above which recognising or redacting one text is slow (seconds).
RECENT_BAD = 20
DIGEST_ROWS = 5
SLOW_RECOGNITION = 0.1
SLOW_REDACTION = 1.0
PROGRESS_INTERVAL = "30 seconds"


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def run_summary(outcomes: DataFrame, is_bad: Column, by: Iterable[str] = ()) -> DataFrame:
    counted = outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_bad).alias("bad")
    )
    return counted.select(
        *by,
        "total",
        (F.col("total") - F.col("bad")).alias("good"),
        "bad",
        _ratio(F.col("bad"), F.col("total")).alias("error_rate"),
    )


def redaction_metrics(
    df: DataFrame, text: Column, failed: Column | None = None, seconds: float | None = None
) -> DataFrame:
    """Texts, characters, error rate, and the share of texts a memo would answer.

    With the ``seconds`` a run took, also its ``chars_per_second``.

    Null and empty texts never reach the analyser. Distinct texts are counted
    on a 256-bit digest, so the shuffle carries 32 bytes per distinct text.
    """
    failed = failed if failed is not None else F.lit(False)
    rows = df.select(text.alias("text"), failed.alias("failed")).filter(F.length("text") > 0)
    counted = rows.agg(
        F.count(F.lit(1)).alias("texts"),
        F.coalesce(F.sum(F.length("text").cast("bigint")), F.lit(0)).alias("chars"),
        F.count_if("failed").alias("errors"),
        F.count_distinct(F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))).alias("distinct_texts"),
    )
    rate = [] if seconds is None else [_ratio(F.col("chars"), F.lit(seconds)).alias("chars_per_second")]
    return counted.select(
        "texts",
        "chars",
        *rate,
        "errors",
        _ratio(F.col("errors"), F.col("texts")).alias("error_rate"),
        "distinct_texts",
        _ratio(F.col("texts") - F.col("distinct_texts"), F.col("texts")).alias("memo_hit_ratio"),
    )


def detector_metrics(df: DataFrame, text: Column, spans: Column, detectors: Iterable[Detector]) -> DataFrame:
    """Per detector: patterns checked (one per text), matches found, match ratio.

    ``spans`` are the analysed spans before overlaps are resolved.
    """
    entities = [d.entity for d in detectors]
    rows = df.select(F.when(F.length(text) > 0, spans).alias("spans"))

    def found_by(entity: str) -> Column:
        own = F.filter("spans", lambda s: s["entity"] == entity)
        return F.sum(F.size(own).cast("bigint")).alias(entity)

    totals = rows.agg(F.count("spans").alias("checked"), *[found_by(e) for e in entities])
    listed = F.array(
        *[
            F.struct(F.lit(e).alias("entity"), F.coalesce(F.col(e), F.lit(0)).alias("found"))
            for e in entities
        ]
    )
    return totals.select("checked", F.explode(listed).alias("x")).select(
        F.col("x.entity").alias("entity"),
        F.col("checked").alias("patterns_checked"),
        F.col("x.found").alias("matches_found"),
        _ratio(F.col("x.found"), F.col("checked")).alias("match_ratio"),
    )


def progress(
    outcomes: DataFrame,
    ts: str,
    is_bad: Column,
    interval: str = PROGRESS_INTERVAL,
    average: tuple[str, str] | None = None,
) -> DataFrame:
    """Processed, good and bad per interval. Works on batch and streaming frames.

    ``average`` names a moving-average column and the column that breaks ties of
    ``ts``: the interval then also shows the average after its last row.
    """
    extra = []
    if average is not None:
        extra = [F.max_by(average[0], F.struct(ts, average[1])).alias(average[0])]
    return (
        outcomes.groupBy(F.window(ts, interval).alias("w"))
        .agg(F.count(F.lit(1)).alias("processed"), F.count_if(is_bad).alias("bad"), *extra)
        .select(
            F.col("w.start").alias("window_start"),
            "processed",
            (F.col("processed") - F.col("bad")).alias("good"),
            "bad",
            *([average[0]] if average is not None else []),
        )
    )


def with_totals(windows: DataFrame) -> DataFrame:
    """Running totals over progress rows.

    Running sums inside each day, on top of the totals of the days before: no
    task sees more than one day of windows, or one row per day.
    """
    counts = ("processed", "good", "bad")
    dated = windows.withColumn("day", F.to_date("window_start"))
    in_day = Window.partitionBy("day").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = dated.groupBy("day").agg(*[F.sum(c).alias(c) for c in counts])
    before = days.select("day", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in counts])
    joined = dated.join(before, "day")
    return joined.select(
        *windows.columns,
        *[(F.sum(c).over(in_day) + F.col(f"{c}_before")).alias(f"{c}_so_far") for c in counts],
    )


def slow_operations(log: DataFrame, seconds: str, limit: float) -> DataFrame:
    return log.filter(F.col(seconds) > limit)


def bad_reasons(routed: DataFrame) -> DataFrame:
    return (
        routed.filter(F.col("status") == "bad")
        .groupBy("error_class")
        .agg(F.count(F.lit(1)).alias("tickets"))
    )


def throughput(events: DataFrame, ts: str, by: Iterable[str] = ()) -> DataFrame:
    """Records per second of elapsed time, 0 when no time passed."""
    at = epoch_micros(events, F.col(ts))
    spent = (F.max(at) - F.min(at)) / F.lit(1e6)
    counted = events.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), spent.alias("seconds"))
    return counted.withColumn(
        "records_per_second", F.coalesce(F.try_divide(F.col("records"), F.col("seconds")), F.lit(0.0))
    )


def recent_bad(
    events: DataFrame, is_bad: Column, key: str, order: Iterable[str], keep: int = RECENT_BAD
) -> DataFrame:
    """The last bad rows per key, ``age`` 1 being the newest.

    Spark limits each partition to ``keep`` rows per key before the shuffle.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return events.filter(is_bad).withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= keep)


# The texts around the samples of a review digest.
DIGEST_HEAD = "Recently flagged 'bad' tickets:\n"
DIGEST_TAIL = (
    "\nIf these are genuinely 'bad', say 'continue'. If there's a pipeline misfire, say 'stop'. "
    "Your output must be strictly valid JSON with keys 'decision' and 'explanation'."
)


def digest(recent: DataFrame, key: str, raw: Column, error: Column, rows: int = DIGEST_ROWS) -> DataFrame:
    """Review text of the last bad rows of each key, oldest first, numbered from 1."""
    last = recent.filter(F.col("age") <= rows).select(
        key, "age", F.coalesce(raw, F.lit("")).alias("raw"), F.coalesce(error, F.lit("")).alias("error")
    )
    oldest_first = F.sort_array(F.collect_list(F.struct("age", "raw", "error")), asc=False)

    def entry(item: Column, i: Column) -> Column:
        return F.concat(
            F.lit("\nTicket "),
            (i + 1).cast("string"),
            F.lit(":\nRaw data:\n"),
            item["raw"],
            F.lit("\nError reason:\n"),
            item["error"],
            F.lit("\n"),
        )

    return (
        last.groupBy(key)
        .agg(oldest_first.alias("items"))
        .select(
            key,
            F.size("items").cast("bigint").alias("samples"),
            F.concat(
                F.lit(DIGEST_HEAD),
                F.array_join(F.transform("items", entry), ""),
                F.lit(DIGEST_TAIL),
            ).alias("digest"),
        )
    )


def health(
    keys: DataFrame,
    recent: DataFrame,
    key: str,
    error_class: Column,
    rows: int = DIGEST_ROWS,
    stop_share: float = 0.5,
) -> DataFrame:
    """Go on or stop, per key, from the classes of its last bad rows.

    Stop when there is no sample to judge, or when at least ``stop_share`` of
    the samples are technical faults rather than bad tickets.
    """
    judged = (
        recent.filter(F.col("age") <= rows)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.count_if(error_class.isin(*TECHNICAL)).alias("technical"),
        )
    )
    decided = keys.select(key).distinct().join(judged, key, "left")
    share = F.try_divide(F.col("technical").cast("double"), F.col("samples").cast("double"))
    return decided.select(
        key,
        F.coalesce("samples", F.lit(0)).alias("samples"),
        F.coalesce("technical", F.lit(0)).alias("technical"),
        F.when(share < stop_share, "continue").otherwise("stop").alias("decision"),
    )


def decision_of(answer: Column) -> Column:
    """A reviewer's JSON answer as continue or stop; whatever cannot be read means stop."""
    said = F.get_json_object(json_verdict(answer)["line"], "$.decision")
    return F.when(F.lower(said) == "continue", "continue").otherwise("stop")
