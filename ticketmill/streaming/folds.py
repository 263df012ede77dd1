"""The sequence operators as Structured Streaming state.

The same folds as the batch operators run per key over state. A stream has no
total order, so a choice is needed:

* without ``delay`` rows are folded as they arrive, ordered within a trigger;
  a row older than one already folded, or without a time, is returned with
  ``late`` true and no verdict, so nothing is lost; `settled` folds the keys
  that have such rows again, in order;
* with ``delay`` rows wait in state until the watermark has passed them and
  are then folded in exact event-time order. Spark drops rows behind the
  watermark and counts them in the query progress. `waiting` gives what is
  left when a stream has ended, so no later row is needed to push it out.

A key's rows of one trigger come in batches. One batch is folded at once; more than
one, and rows that wait, are put into map state as sorted runs cut into slices, and
merged from there: a task holds a slice of each run, never the rows of a key. Waiting
rows are appended as runs of their own, and slices once read are removed; a timer at the
earliest waiting row wakes the key. The state is kept by RocksDB, on disk.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.time import epoch_micros, with_event_time
from ..operators.blocks import _INPUT, _TYPES

_AT = "__at"
SLICE_ROWS = 1000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _pack(frame: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()



def _until(frame: pd.DataFrame, tie: str, last: tuple[int, int]) -> int:
    """How many rows of a sorted frame are not after ``last``."""
    at, ties = frame[_AT].to_numpy(np.int64), frame[tie].to_numpy(np.int64)
    low, high = np.searchsorted(at, last[0], "left"), np.searchsorted(at, last[0], "right")
    return int(low + np.searchsorted(ties[low:high], last[1], "right"))


class Runs:
    """Sorted runs of a key's rows in map state, cut into slices of SLICE_ROWS."""

    def __init__(self, slices: Any, runs: Any, tie: str):
        self.slices, self.runs, self.tie = slices, runs, tie

    def add(self, number: int, rows: pd.DataFrame) -> int:
        """A run of new rows; returns the time of the earliest."""
        rows = rows.sort_values([_AT, self.tie], kind="stable")
        for i, at in enumerate(range(0, len(rows), SLICE_ROWS)):
            self.slices.updateValue((number, i), (_pack(rows.iloc[at : at + SLICE_ROWS]),))
        self.runs.updateValue((number,), (0, -(-len(rows) // SLICE_ROWS)))
        return int(rows[_AT].iloc[0])

    def merged(self, until: int | None = None) -> Iterator[pd.DataFrame]:
        """Takes out the rows up to a time (all: None), in order, some at a time."""
        heads: dict[int, list] = {}  # of each run: its first slice, where that lies, the run's end
        for (number,), (first, end) in sorted(self.runs.iterator()):
            heads[number] = [_unpack(self.slices.getValue((number, first))[0]), first, end, False]
        limit = (math.inf, 0) if until is None else (until, math.inf)
        while heads:
            # What is not after the last row of any slice with others behind it is complete.
            ends = [(int(h[0][_AT].iloc[-1]), int(h[0][self.tie].iloc[-1])) for h in heads.values() if h[1] + 1 < h[2]]
            bound = min([*ends, limit])
            ready = []
            for number, head in list(heads.items()):
                count = len(head[0]) if bound[0] == math.inf else _until(head[0], self.tie, bound)
                if not count:
                    continue
                ready.append(head[0].iloc[:count])
                head[0], head[3] = head[0].iloc[count:], True
                if len(head[0]):
                    continue
                self.slices.removeKey((number, head[1]))
                head[1], head[3] = head[1] + 1, False
                if head[1] == head[2]:
                    self.runs.removeKey((number,))
                    del heads[number]
                else:
                    self.runs.updateValue((number,), (head[1], head[2]))
                    head[0] = _unpack(self.slices.getValue((number, head[1]))[0])
            if ready:
                yield pd.concat(ready, ignore_index=True).sort_values([_AT, self.tie], kind="stable", ignore_index=True)
            if bound == limit:
                break
        for number, head in heads.items():
            if head[3]:  # begun
                self.slices.updateValue((number, head[1]), (_pack(head[0]),))
        self.earliest = min((int(h[0][_AT].iloc[0]) for h in heads.values()), default=None)


class _Folder(StatefulProcessor):
    """One key's fold over state."""

    def __init__(self, fold, names: list[str], columns: list[str], tie: str, waits: bool):
        self.fold, self.names, self.columns, self.tie, self.waits = fold, names, columns, tie, waits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("fold", "state string, last_at long, last_tie long, run long")
        # The row of a key in these is small: what a slice holds is one binary value.
        self.runs = Runs(
            handle.getMapState("slices", "run long, slice long", "rows binary"),
            handle.getMapState("runs", "run long", "first long, end long"),
            self.tie,
        )

    def _load(self) -> tuple[tuple, tuple | None, int]:
        held = self.state.get()
        if held is None:
            return self.fold.first(), None, 0
        stored, at, tie, run = held
        return tuple(json.loads(stored)), None if at is None else (at, tie), run

    def _save(self, state: tuple, last: tuple | None, run: int) -> None:
        self.state.update((json.dumps(state), *(last or (None, None)), run))

    def _folded(self, rows: pd.DataFrame, state: tuple) -> tuple[pd.DataFrame, tuple]:
        outputs, state = self.fold.segment([rows[_INPUT + n].tolist() for n in self.fold.inputs], state)
        out = rows[self.names].reset_index(drop=True)
        for (name, _), values in zip(self.fold.outputs, outputs):
            out[name] = pd.Series(values, dtype=object)
        return out, state

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # Spark makes up new names for columns that begin with an underscore.
        frames = (f.set_axis(self.columns, axis=1) for f in rows if len(f))
        yield from self._await(frames) if self.waits else self._arrived(frames)

    def _await(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last, run = self._load()
        for frame in frames:
            self.handle.registerTimer(-(-self.runs.add(run, frame) // 1000))
            run += 1
        self._save(state, last, run)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state, last, run = self._load()
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        for rows in self.runs.merged(reached):
            out, state = self._folded(rows, state)
            yield out
        self._save(state, last, run)
        if self.runs.earliest is not None:
            self.handle.registerTimer(max(-(-self.runs.earliest // 1000), reached // 1000 + 1))

    def _arrived(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last, _ = self._load()
        newest, run, held = last, 0, None
        for frame in frames:
            late = frame[_AT].isna() | frame[self.tie].isna()
            if last is not None:
                late |= (frame[_AT] < last[0]) | ((frame[_AT] == last[0]) & (frame[self.tie] < last[1]))
            if late.any():
                passed = frame.loc[late, self.names].reset_index(drop=True)
                yield passed.assign(**{n: None for n, _ in self.fold.outputs}, late=True)
                frame = frame[~late]
            if held is not None and len(held):
                self.runs.add(run, held)  # there is more than one batch: all go by way of the state
                run += 1
            held = frame
        if held is None or (not len(held) and not run):
            return
        if run:
            if len(held):
                self.runs.add(run, held)
            pieces = self.runs.merged()
        else:
            pieces = iter([held.sort_values([_AT, self.tie], kind="stable")])
        for rows in pieces:
            out, state = self._folded(rows, state)
            newest = int(rows[_AT].iloc[-1]), int(rows[self.tie].iloc[-1])
            yield out.assign(late=False)
        self._save(state, newest, 0)


def stream_fold(
    stream: DataFrame,
    key: str,
    ts: str,
    tie: str,
    inputs: dict[str, Column],
    fold,
    delay: str | None = None,
) -> DataFrame:
    """Streaming rows with the output columns of ``fold`` (and ``late`` without ``delay``).

    Rows are ordered by ``ts`` and then by the integer column ``tie``. Sets the session's
    state store to RocksDB, which map state and timers need, for the queries started after it.
    """
    stream.sparkSession.conf.set(PROVIDER, ROCKS)
    if delay is not None:
        stream = with_event_time(stream, ts)
    prepared = stream.withColumns(
        {_AT: epoch_micros(stream, F.col(ts)), **{_INPUT + n: inputs[n] for n in fold.inputs}}
    )
    if delay is not None:
        prepared = prepared.withWatermark(ts, delay).filter(F.col(_AT).isNotNull() & F.col(tie).isNotNull())
    marks = [] if delay is not None else [T.StructField("late", T.BooleanType())]
    schema = T.StructType(
        [*stream.schema.fields, *(T.StructField(n, _TYPES[k][0]) for n, k in fold.outputs), *marks]
    )
    folder = _Folder(fold, stream.columns, prepared.columns, tie, delay is not None)
    return prepared.groupBy(key).transformWithStateInPandas(
        folder, schema, "append", "None" if delay is None else "EventTime"
    )


def _walked(frames: Iterable[pd.DataFrame], folder: _Folder, key: str) -> Iterator[pd.DataFrame]:
    """Rows in (key, time) order, each key's fold going on from its column ``__state``."""
    current = state = None
    for frame in frames:
        keys = frame[key].astype(object).where(frame[key].notna(), None)
        for k, rows in frame.groupby((keys != keys.shift()).cumsum(), sort=False):
            this = keys.loc[rows.index[0]]
            if state is None or this != current:
                current, held = this, rows["__state"].iloc[0]
                state = tuple(json.loads(held)) if isinstance(held, str) else folder.fold.first()
            out, state = folder._folded(rows, state)
            yield out


def waiting(spark: SparkSession, checkpoint: str, rows: DataFrame, key: str, ts: str, tie: str, inputs: dict[str, Column], fold) -> DataFrame:
    """The rows an ended `stream_fold` with ``delay`` still holds, folded in order from where its state stands.

    ``rows`` has the columns of the streamed rows, as a table or an empty one; key, ts, tie, inputs and fold are
    those of the stream. The stream's own state stays as it is.
    """
    rows = with_event_time(rows.limit(0), ts)
    prepared = rows.withColumns({_AT: epoch_micros(rows, F.col(ts)), **{_INPUT + n: inputs[n] for n in fold.inputs}})
    kept = lambda name: spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    kinds, zone = to_arrow_schema(prepared.schema), spark.conf.get("spark.sql.session.timeZone")

    def column(table: pa.Table, field: pa.Field) -> pa.ChunkedArray:
        values = table[field.name]
        if pa.types.is_timestamp(field.type) and field.type.tz and pa.types.is_timestamp(values.type) and not values.type.tz:
            values = pc.assume_timezone(values, zone)  # pandas has them as local times
        return values.cast(field.type)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                table = pa.ipc.open_stream(data).read_all()
                yield from pa.Table.from_arrays([column(table, f) for f in kinds], schema=kinds).to_batches()

    held = kept("slices").select(F.col("user_map_value.rows")).mapInArrow(unpacked, prepared.schema)
    states = kept("fold").select(F.col(f"key.{key}").alias("__key"), F.col("value.state").alias("__state"))
    joined = held.join(states, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    ordered = joined.repartition(key).sortWithinPartitions(key, _AT, tie)
    folder = _Folder(fold, rows.columns, prepared.columns, tie, True)
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, _TYPES[k][0]) for n, k in fold.outputs)])
    return ordered.mapInPandas(lambda frames: _walked(frames, folder, key), schema)


def settled(rows: DataFrame, key: str, fold, again: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that a drained `stream_fold` without ``delay`` wrote, none of them late.

    Keys without late rows stand as they are. Those with some are folded ``again`` by
    the batch operator, which orders all rows of a key and splits large keys.
    """
    late = rows.filter("late").select(F.col(key).alias("__late_key")).distinct()
    same = F.col(key).eqNullSafe(F.col("__late_key"))
    columns = [c for c in rows.columns if c not in ("late", *(n for n, _ in fold.outputs))]
    on_time = rows.join(late, same, "left_anti").drop("late")
    return on_time.unionByName(again(rows.join(late, same, "left_semi").select(*columns)))


def stream_recent(
    stream: DataFrame, key: str, order: Iterable[str], columns: Iterable[str], keep: int
) -> DataFrame:
    """The newest ``keep`` rows of each key that got new rows, ``age`` 1 being the newest."""
    order, columns = list(order), list(columns)
    picked = stream.select(key, *dict.fromkeys([*order, *columns]))
    schema = T.StructType([*picked.schema.fields, T.StructField("age", T.IntegerType())])

    def update(k: tuple, frames: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        held = [_unpack(group.get[0])] if group.exists else []
        rows = pd.concat(held, ignore_index=True) if held else None
        for frame in frames:
            merged = frame if rows is None else pd.concat([rows, frame], ignore_index=True)
            rows = merged.sort_values(order, ascending=False).head(keep)
        rows = rows.reset_index(drop=True)
        group.update((_pack(rows),))
        yield rows.assign(age=range(1, len(rows) + 1))

    return picked.groupBy(key).applyInPandasWithState(
        update, schema, "held binary", "update", GroupStateTimeout.NoTimeout
    )
