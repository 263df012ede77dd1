"""Measured times of detectors and texts, as quantile sketches that tasks fill and Spark adds up.

A time is counted in the bucket of its logarithm, so that a bucket's middle is within
ACCURACY of all times in it. Counts per bucket add up, in a task and across tasks, so a
sketch is a few hundred rows whatever the number of texts, and a quantile read from it is
within ACCURACY of the exact one; numbers of texts, matches and slow texts are exact.

Defined cases: null and empty texts are not analysed; times below a nanosecond count as
one; no rows give no rows.
"""

from __future__ import annotations

import math
import time
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.detectors import Detector
from ..functions.span_udfs import _compiled, _find

ACCURACY = 0.01
_GROWTH = math.log((1 + ACCURACY) / (1 - ACCURACY))
WHOLE = "text"  # the entity under which whole texts are timed


def bucket(seconds: float) -> int:
    return math.ceil(math.log(max(seconds, 1e-9)) / _GROWTH)


def middle(number: Column) -> Column:
    """The time that stands for a bucket: no time in it is further off than ACCURACY."""
    return F.exp(number * F.lit(_GROWTH)) * F.lit(2 / (1 + math.exp(_GROWTH)))


def timed(df: DataFrame, text: str, detectors: Iterable[Detector], context: bool = False) -> DataFrame:
    """The sketch (entity, bucket, texts, matches, seconds): one analysis of each text, timed per detector."""
    compiled = _compiled(tuple(detectors))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, matches, seconds = Counter(), Counter(), Counter()

        def add(entity: str, took: float, found: int) -> None:
            key = entity, bucket(took)
            texts[key] += 1
            matches[key] += found
            seconds[key] += took

        for batch in batches:
            for value in batch.column(0).to_pylist():
                if not value:
                    continue
                whole = total = 0
                for one in compiled:
                    begun = time.perf_counter()
                    found = len(_find(value, [one], context))
                    took = time.perf_counter() - begun
                    add(one[0], took, found)
                    whole, total = whole + took, total + found
                add(WHOLE, whole, total)
        keys = list(texts)
        columns = [[k[0] for k in keys], [k[1] for k in keys], [texts[k] for k in keys], [matches[k] for k in keys], [seconds[k] for k in keys]]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
        names = ["entity", "bucket", "texts", "matches", "seconds"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    parts = df.select(F.make_valid_utf8(F.col(text))).mapInArrow(measure, "entity string, bucket int, texts long, matches long, seconds double")
    return parts.groupBy("entity", "bucket").agg(*[F.sum(c).alias(c) for c in ("texts", "matches", "seconds")])


def quantiles(sketch: DataFrame, shares: Iterable[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Per entity: texts, matches, seconds in all, and the quantiles of the time of a text (p50, p95, ...)."""
    order = Window.partitionBy("entity").orderBy("bucket")
    whole = Window.partitionBy("entity")
    ranked = sketch.withColumns({"upto": F.sum("texts").over(order), "all": F.sum("texts").over(whole)})
    found = [
        F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * F.lit(share)), middle(F.col("bucket")))).alias(f"p{share * 100:g}") for share in shares
    ]
    return ranked.groupBy("entity").agg(*[F.sum(c).alias(c) for c in ("texts", "matches", "seconds")], *found)


def slow_texts(df: DataFrame, key: str, text: str, detectors: Iterable[Detector], limit: float, context: bool = False) -> DataFrame:
    """(key, seconds) of the texts whose analysis took longer than ``limit`` seconds, as measured."""
    compiled = _compiled(tuple(detectors))
    kind = df.select(key).schema[0].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, took = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                begun = time.perf_counter()
                if value:
                    _find(value, compiled, context)
                seconds = time.perf_counter() - begun
                if value and seconds > limit:
                    chosen.append(i)
                    took.append(seconds)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(chosen, pa.int64())), pa.array(took, pa.float64())], names=["key", "seconds"])

    rows = df.select(F.col(key).alias("key"), F.make_valid_utf8(F.col(text)))
    return rows.mapInArrow(measure, f"key {kind}, seconds double").select(F.col("key").alias(key), "seconds")
