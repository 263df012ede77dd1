"""Ordered folds over keys of any size.

A fold needs the rows of a key in order, but one key may hold a third of all
rows, so a key is never brought to one task. Rows are range-partitioned by
(key, order) and stored: a large key then spans several blocks, each walked by its
own task. A block that begins inside a key needs the state its predecessor ends
with. So the last key of each block that goes on elsewhere is first read for its
chart, the small function from any state before its rows to the state after them;
the charts are applied one after the other, and then all blocks are walked from the
right states. Two passes, whatever the rows and the fold.

The first pass reads the key and the fold's inputs only. A block's chart and border
keys are all that reaches the driver, the charts one at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_folder

BLOCK = "__block"
_PART = "__part"
_FILE_BITS = 40  # a block's file is shorter than a terabyte
_INPUT = "__in_"
_TYPES = {
    "double": (T.DoubleType(), pa.float64()),
    "long": (T.LongType(), pa.int64()),
    "string": (T.StringType(), pa.string()),
    "boolean": (T.BooleanType(), pa.bool_()),
}


def ordered_blocks(df: DataFrame, key: str, order: Iterable[str], blocks: int | None = None) -> DataFrame:
    """``df`` in (key, order) with a block number, stored below the run's folder.

    What is stored stays the same even when executors are lost. A block is the part of a
    stored file that one task reads; blocks are numbered in the order of their rows. Without
    ``blocks`` the number of files is the session's shuffle partitions, which adaptive
    execution merges for small data.
    """
    columns = [key, *order]
    spark = df.sparkSession
    if not df._jdf.queryExecution().analyzed().deterministic():
        # Ranges are sampled first: what must run once (a model call, say) is stored before.
        folder = run_folder(spark, "rows")
        df.write.parquet(folder)
        df = spark.read.parquet(folder)
    ranged = df.repartitionByRange(*([blocks] if blocks else []), *columns)
    ranged = ranged.sortWithinPartitions(*columns).withColumn(_PART, F.spark_partition_id())
    folder = run_folder(spark, "blocks")
    ranged.write.option("maxRecordsPerFile", 0).parquet(folder)
    stored = spark.read.schema(ranged.schema).parquet(folder)
    place = F.shiftleft(F.col(_PART).cast("long"), _FILE_BITS) + F.col("_metadata.file_block_start")
    return stored.withColumn(BLOCK, place).drop(_PART)


def _runs(keys: list) -> Iterator[tuple[int, int]]:
    at = 0
    for _, same in groupby(keys):
        n = sum(1 for _ in same)
        yield at, at + n
        at += n


def _values(column: pa.Array) -> list:
    """Plain Python values; by way of numpy where that is the same and faster."""
    kind = column.type
    if column.null_count == 0 and (pa.types.is_integer(kind) or pa.types.is_boolean(kind) or pa.types.is_float64(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _inputs(batch: pa.RecordBatch, fold) -> list[list]:
    return [_values(batch.column(_INPUT + name)) for name in fold.inputs]


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of one block each; a task may read several blocks, one after the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = batch.column(BLOCK).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin) if len(cuts) > 2 else batch


def _walk(
    batches: Iterator[pa.RecordBatch], key: str, fold, starts: dict
) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
    """Each batch of a block with its fold outputs."""
    block = current = state = None
    for batch in _by_block(batches):
        keys, columns = _values(batch.column(key)), _inputs(batch, fold)
        outputs: list[list] = [[] for _ in fold.outputs]
        this = batch.column(BLOCK)[0].as_py()
        for begin, end in _runs(keys):
            if this != block:
                block, current, state = this, keys[begin], starts.get(this, fold.first())
            elif keys[begin] != current:
                current, state = keys[begin], fold.first()
            part, state = fold.segment([c[begin:end] for c in columns], state)
            for out, values in zip(outputs, part):
                out.extend(values)
        yield batch, outputs


@dataclass
class Block:
    first_key: Any
    last_key: Any

    @property
    def single(self) -> bool:
        return self.first_key == self.last_key


def _borders(frozen: DataFrame, key: str) -> dict[int, Block]:
    """First and last key of each block: an aggregate of one row per block."""
    has_null = F.count_if(F.col(key).isNull()) > 0
    rows = frozen.groupBy(BLOCK).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), has_null.alias("has_null")
    )
    # Nulls sort first.
    return {
        r[BLOCK]: Block(None if r["has_null"] else r["low"], r["high"])
        for r in sorted(rows.collect(), key=lambda r: r[BLOCK])
    }


def _charts(frozen: DataFrame, key: str, fold, blocks: dict[int, Block]) -> Iterator[tuple[int, list]]:
    """The chart of the last key of ``blocks``, by block.

    Only rows of that key leave the JVM: blocks full of small keys cost nothing.
    """
    kind = T.StructType([T.StructField("b", T.LongType()), T.StructField("k", frozen.schema[key].dataType)])
    spark = frozen.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(b, x.last_key) for b, x in blocks.items()], kind))
    chosen = frozen.join(wanted, (F.col(BLOCK) == F.col("b")) & F.col(key).eqNullSafe(F.col("k")), "left_semi")

    def chart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = found = None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "chart": pa.array([json.dumps(found)], pa.string())})

        for batch in _by_block(batches):
            this = batch.column(BLOCK)[0].as_py()
            if this != block:
                if block is not None:
                    yield row()
                block, found = this, fold.chart()
            found = fold.extend(found, _inputs(batch, fold))
        if block is not None:
            yield row()

    needed = chosen.select(BLOCK, *[_INPUT + name for name in fold.inputs])
    rows = needed.mapInArrow(chart, "block long, chart string").orderBy("block")
    for row in rows.toLocalIterator():
        yield row["block"], json.loads(row["chart"])


def link_blocks(frozen: DataFrame, key: str, fold) -> dict[int, tuple]:
    """The state before each block that continues a key."""
    known = _borders(frozen, key)
    order = list(known)
    following = {a: b for a, b in zip(order, order[1:]) if known[a].last_key == known[b].first_key}
    starts: dict[int, tuple] = {}
    if not following:
        return starts
    for block, chart in _charts(frozen, key, fold, {b: known[b] for b in following}):
        # A block with several keys begins its last one itself.
        before = starts.get(block, fold.first()) if known[block].single else fold.first()
        starts[following[block]] = fold.resume(fold.through(chart, before))
    return starts


def fold_rows(
    df: DataFrame,
    key: str,
    order: Iterable[str],
    inputs: dict[str, Column],
    fold,
    blocks: int | None = None,
) -> DataFrame:
    """``df`` with the output columns of ``fold``, run per key in order."""
    order = list(order)
    prepared = df.withColumns({_INPUT + name: inputs[name] for name in fold.inputs})
    frozen = ordered_blocks(prepared, key, order, blocks)
    starts = link_blocks(frozen, key, fold)
    names = df.columns
    schema = T.StructType(
        [*df.schema.fields, *(T.StructField(n, _TYPES[kind][0]) for n, kind in fold.outputs)]
    )
    arrow_types = {kind: arrow for kind, (_, arrow) in _TYPES.items()}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, outputs in _walk(batches, key, fold, starts):
            arrays = [batch.column(n) for n in names]
            arrays += [
                pa.array(values, type=arrow_types[kind])
                for values, (_, kind) in zip(outputs, fold.outputs)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *(n for n, _ in fold.outputs)])

    return frozen.mapInArrow(apply, schema)
