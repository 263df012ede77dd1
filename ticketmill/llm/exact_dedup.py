"""Exact copies of texts, found with two passes over a saturating Bloom filter.

First pass: each row's text gives a 64-bit hash, the hash a segment of the filter
and PROBES positions in it. Tasks send the positions, not the rows; a position
counts 0, 1 or "2 or more". Second pass: a row whose positions are all "2 or more"
may have a copy, and only such rows are shuffled and compared by SHA-256. Every
other row is proven unique and passes straight through.

Defined cases: a null text is an empty one; null ids sort after all others; of
rows equal in text and id one stays; a very long text is a digest like any other; no
rows give no rows; all columns pass unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stored, text_of

SEGMENT_BITS = 1 << 20
BITS_PER_ROW = 8
PROBES = 3
# The filter is sent to all tasks up to this size; beyond it, rows go to their segment. `mark_copies` then moves
# digests of 40 bytes; `drop_copies`, which returns whole rows, moves those.
SHIPPED_BYTES = 64 << 20

_PLACES = [f"_p{i}" for i in range(PROBES)]


def normalised(text: Column | str) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", " ")


def _probes(df: DataFrame, digest: str, segments: int) -> DataFrame:
    places = [F.pmod(F.xxhash64(F.col(digest), F.lit(i)), F.lit(SEGMENT_BITS)).cast("int").alias(p) for i, p in enumerate(_PLACES)]
    return df.select("*", F.pmod(F.col(digest), F.lit(segments)).cast("int").alias("_segment"), *places)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each batch and segment: positions, doubled, plus one where met again."""
    for batch in batches:
        segment = np.repeat(batch.column(0).to_numpy().astype(np.int64), PROBES)
        place = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1).ravel()
        keys, counts = np.unique(segment * SEGMENT_BITS + place, return_counts=True)
        owner = keys // SEGMENT_BITS
        packed = ((keys % SEGMENT_BITS) * 2 + (counts > 1)).astype(np.uint32)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(keys) else []
        parts = np.split(packed, starts[1:]) if len(keys) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[starts].astype(np.int32), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["_segment", "_packed"],
        )


def _merged(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    seen = np.zeros(SEGMENT_BITS, np.uint8)
    for part in parts["_packed"]:
        packed = np.frombuffer(part, np.uint32)
        place = packed >> 1
        seen[place] = np.minimum(seen[place] + 1 + (packed & 1), 2)
    words = np.packbits(seen == 2, bitorder="little").view(np.int64)
    return pd.DataFrame({"_segment": [key[0]], "_words": [words]})


def _flagged(rows: DataFrame, digest: str) -> DataFrame:
    """``rows`` with ``_maybe``: false where no other row has the 64-bit hash in ``digest``."""
    count = rows.count()
    segments = max(1, -(-count * BITS_PER_ROW // SEGMENT_BITS))
    filter_ = (
        _probes(rows.select(digest), digest, segments)
        .select("_segment", *_PLACES)
        .mapInArrow(_counted, "_segment int, _packed binary")
        .groupBy("_segment")
        .applyInPandas(_merged, "_segment int, _words array<bigint>")
    )
    if segments * SEGMENT_BITS // 8 <= SHIPPED_BYTES:
        filter_ = F.broadcast(filter_)
    probed = _probes(rows, digest, segments).join(filter_, "_segment", "left")
    hit = [F.getbit(F.get("_words", F.shiftright(p, 6)), F.col(p).bitwiseAND(63)) == 1 for p in _PLACES]
    maybe = F.lit(True)
    for one in hit:
        maybe = maybe & one
    return probed.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).drop("_segment", "_words", *_PLACES)


def possible_copies(df: DataFrame, text: Column | str) -> DataFrame:
    """``df`` with ``_maybe``: false for rows whose normalised text no other row has."""
    return _flagged(df.withColumn("_hash", F.xxhash64(normalised(text))), "_hash").drop("_hash")


def mark_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised text the one with the smallest key is kept. Texts are read
    once, for their digests, and never moved. Only (key, digest) of possible copies is
    shuffled, summed per task first, so a group of any size is one row a task; groups are
    expanded from counts.
    """
    rows = df.select(F.col(key).alias("_key"), normalised(text).alias("_text"))
    rows = stored(rows.select("_key", F.xxhash64("_text").alias("_hash"), F.sha2("_text", 256).alias("text_sha256")), "digests")
    rows = stored(_flagged(rows, "_hash").select("_key", "_maybe", "text_sha256"), "copies")
    alone = rows.filter(~F.col("_maybe")).select(
        F.col("_key").alias(key),
        F.col("_key").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    maybe = rows.filter("_maybe")
    members = maybe.groupBy("text_sha256", "_key").agg(F.count("*").alias("_copies"))
    groups = maybe.groupBy("text_sha256").agg(F.min("_key").alias("keep_id"), F.count("*").alias("group_size"))
    found = (
        join_hot(members, groups, "text_sha256", "group_size", rows.count())
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
        .select(
            F.col("_key").alias(key),
            "keep_id",
            "group_size",
            (F.col("_key").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return alone.unionByName(found)


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that ``mark_copies`` keeps, with all their columns."""
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
    # The row's own columns stand apart, so none can clash with the inner ones.
    rows = df.select(F.struct(*columns).alias("_row"), F.col(key).alias("_key"), normalised(text).alias("_text"))
    rows = _flagged(rows.withColumn("_hash", F.xxhash64("_text")), "_hash")
    alone = rows.filter(~F.col("_maybe")).select("_row")
    kept = (
        rows.filter("_maybe")
        .select(F.sha2("_text", 256).alias("_digest"), "_key", "_row")
        .groupBy("_digest")
        .agg(F.min_by("_row", F.struct(F.col("_key").isNull(), F.col("_key"))).alias("_row"))
        .select("_row")
    )
    return alone.unionByName(kept).select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(df.columns)])
