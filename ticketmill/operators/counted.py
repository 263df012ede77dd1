"""JSON lines written with counts of what was written: records, bytes, operations, skipped records and time.

A data source writer. Each task writes a file of its own to a staging folder, lines
buffered up to a number of bytes, and returns what it has written with its commit
message; the commit moves the files of the tasks that count to their place and writes the
sums beside them. So a task that ran twice is counted once, and a job that fails leaves
nothing in place.

Defined cases: a record that strict JSON cannot hold (a number that is none, bytes, half a
surrogate pair) is skipped and counted; nulls are kept; times are written as ISO texts,
decimals as numbers; an empty partition writes no file; no rows give zeros.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources.ranges import located

BUFFER_BYTES = 1 << 20
METRICS = {"records": "long", "bytes": "long", "operations": "long", "skipped": "long", "seconds": "double"}
_METRICS_FILE = "_metrics.json"


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    records: int = 0
    bytes: int = 0
    operations: int = 0
    skipped: int = 0
    seconds: float = 0.0


def _plain(value: object) -> object:
    if isinstance(value, dt.date | dt.datetime | dt.time):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    raise TypeError(type(value).__name__)


def json_line(record: dict) -> bytes | None:
    """A record as a line; None for one that strict JSON cannot hold."""
    try:
        return (json.dumps(record, ensure_ascii=False, allow_nan=False, separators=(",", ":"), default=_plain) + "\n").encode()
    except (TypeError, ValueError):
        return None


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.buffer = int(options.get("bufferBytes", BUFFER_BYTES))
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.jsonl"
        system, folder = located(self.staging)
        done, out, held = Written(None), None, bytearray()

        def flush() -> None:
            nonlocal out
            begun = time.perf_counter()
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}", compression=None)
                done.file = name
            out.write(bytes(held))
            done.operations, done.bytes = done.operations + 1, done.bytes + len(held)
            done.seconds += time.perf_counter() - begun
            held.clear()

        for batch in iterator:
            for record in batch.to_pylist():
                line = json_line(record)
                if line is None:
                    done.skipped += 1
                    continue
                held += line
                done.records += 1
                if len(held) >= self.buffer:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = located(self.path)
        _, staged = located(self.staging)
        if self.overwrite and system.get_file_info(folder).type == fs.FileType.Directory:
            for entry in system.get_file_info(fs.FileSelector(folder)):
                if entry.base_name.startswith("part-") and entry.is_file:
                    system.delete_file(entry.path)
        system.create_dir(folder, recursive=True)
        written = [m for m in messages if m is not None]
        for message in written:
            if message.file:
                system.move(f"{staged}/{message.file}", f"{folder}/{message.file}")
        sums = {n: sum(getattr(m, n) for m in written) for n in METRICS}
        with system.open_output_stream(f"{folder}/{_METRICS_FILE}") as out:
            out.write(json.dumps(sums).encode())
        self._clear(system, staged)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*located(self.staging))

    @staticmethod
    def _clear(system: fs.FileSystem, folder: str) -> None:
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class CountedLines(DataSource):
    """JSON lines with counts; options: path, bufferBytes."""

    @classmethod
    def name(cls) -> str:
        return "counted_jsonl"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)


def write_counted(df: DataFrame, path: str, mode: str = "append", **options: str) -> DataFrame:
    """Writes the rows as JSON lines; returns one row: records, bytes, operations, skipped, seconds and records_per_second.

    ``seconds`` is the time tasks spent writing, added up.
    """
    spark = df.sparkSession
    spark.dataSource.register(CountedLines)
    df.write.format("counted_jsonl").mode(mode).options(path=path, **options).save()
    system, folder = located(path)
    with system.open_input_stream(f"{folder}/{_METRICS_FILE}") as source:
        sums = json.loads(source.read())
    row = spark.createDataFrame([tuple(sums[n] for n in METRICS)], ", ".join(f"{n} {k}" for n, k in METRICS.items()))
    return row.withColumn("records_per_second", F.when(F.col("seconds") > 0, F.col("records") / F.col("seconds")))
