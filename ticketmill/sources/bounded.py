"""Line files as a stream whose triggers hold at most so many lines, within a file too.

Two parts. `index_lines` is a Spark job over byte ranges of the files: it finds the byte at
which every n-th line of a file begins, so a file becomes chunks of n lines, the last one
shorter. `BoundedLines` is a streaming data source over that index: its offset is (file,
byte), a trigger is one chunk, and the chunk's bytes are read by the tasks in ranges. The
driver reads a line of the index for each trigger, and none of the data.

A restarted query goes on from the offset its checkpoint has planned. Files that come later
are taken up by calling `index_lines` again, while the query runs or not: each call adds the
files that are not indexed yet. A file must not change once it is indexed.

Defined cases: an empty file has no chunk; a last line without a line feed counts; empty
lines are lines; ``\\r\\n`` ends a line like ``\\n``; bytes that are no UTF-8 stay as they are.

A trigger costs its planning and commits, whatever it holds, and one chunk is one task.
`stream_lanes` gives several streams over one index, each with every n-th chunk and a
checkpoint of its own, so that as many triggers go on at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from .ranges import RANGE_BYTES, byte_ranges, lines_between, list_files, located, pieces, spread_ranges

# Fixed value: lines a chunk holds unless told otherwise.
CHUNK_LINES = 130_000
BATCH_BYTES = 4 << 20
# Streams at once: each has a process on the driver that plans its triggers.
MAX_LANES = 8


def _ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in batch.schema.names), strict=True)


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for file, size, begin, end in _ranges_of(batches):
        system, path = located(file)
        with system.open_input_file(path) as source:
            rows.append((file, size, begin, end, sum(data.count(b"\n") for data in pieces(source, begin, end))))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "size", "begin", "end", "ends"])


def _cuts(every: int):
    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bytes after each line feed whose number in the file is a multiple of ``every``."""
        for file, size, begin, end, before in _ranges_of(batches):
            system, path = located(file)
            at, seen, found = begin, before, []
            with system.open_input_file(path) as source:
                for data in pieces(source, begin, end):
                    feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
                    chosen = feeds[(every - seen - 1) % every :: every]
                    found += [at + int(x) + 1 for x in chosen]
                    at, seen = at + len(data), seen + len(feeds)
            found = [x for x in found if x < size]
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(found), pa.string()), pa.array(found, pa.int64())], names=["file", "byte"])

    return cuts


def chunks(files: DataFrame, every: int = CHUNK_LINES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, byte, end): the chunks of ``every`` lines of files (file, size), the last of a file shorter.

    One pass counts the line feeds of each range; only ranges that hold a cut are read again.
    """
    counted = spread_ranges(byte_ranges(files.select("file", "size"), range_bytes)).mapInArrow(
        _count_lines, "file string, size long, begin long, end long, ends long"
    )
    # A range each row: some thousands for a large file.
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    crossed = placed.filter(F.expr(f"(before + ends) div {every} > before div {every}"))
    found = spread_ranges(crossed.select("file", "size", "begin", "end", "before")).mapInArrow(_cuts(every), "file string, byte long")
    begins = found.unionByName(files.filter("size > 0").select("file", F.lit(0).cast("long").alias("byte")))
    following = F.lead("byte").over(Window.partitionBy("file").orderBy("byte"))
    ended = begins.withColumn("end", following).join(files.select("file", "size", "modified"), "file")
    return ended.select("file", "byte", F.coalesce("end", "size").alias("end"), "modified")


def index_lines(spark: SparkSession, path: str, index: str, every: int = CHUNK_LINES, glob: str = "*") -> int:
    """Adds the chunks of the files below ``path`` that ``index`` does not have yet; returns how many.

    A call is one part of the index, numbered in order and written whole or not at all.
    """
    files = list_files(spark, path, glob)
    system, folder = located(index)
    parts = _parts(system, folder)
    if parts:
        schema = "file string, byte long, end long, modified timestamp"
        known = spark.read.schema(schema).parquet(*[f"{index}/{p}" for p in parts]).select("file").distinct()
        files = files.join(known, "file", "left_anti")
    found = chunks(files, every).orderBy("modified", "file", "byte")
    part = f"{index}/part-{len(parts):08d}"
    found.write.parquet(part)
    return spark.read.parquet(part).count()


def _parts(system: fs.FileSystem, folder: str) -> list[str]:
    """Finished parts of an index, in order."""
    if system.get_file_info(folder).type != fs.FileType.Directory:
        return []
    entries = system.get_file_info(fs.FileSelector(folder, recursive=True))
    done = {e.path.rsplit("/", 2)[-2] for e in entries if e.base_name == "_SUCCESS"}
    return sorted(done)


class Chunk(InputPartition):
    def __init__(self, file: str, begin: int, end: int):
        super().__init__((file, begin, end))
        self.file, self.begin, self.end = file, begin, end


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.index, self.checkpoint = options["index"], options.get("checkpoint")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.lane, self.lanes = int(options.get("lane", 0)), int(options.get("lanes", 1))
        if not 0 <= self.lane < self.lanes:
            raise ValueError(f"there is no lane {self.lane} of {self.lanes}")
        self.parts: list[str] = []  # read so far
        self.order: list[tuple[str, int, int]] = []  # chunks not yet planned, and those of the last trigger
        self.planned: dict | None = None

    def initialOffset(self) -> dict:
        return self._offset("", 0, 0, 0)

    def _offset(self, file: str, byte: int, part: int, chunk: int) -> dict:
        lane = {"lane": self.lane, "lanes": self.lanes} if self.lanes > 1 else {}
        return {"index": self.index, "file": file, "byte": byte, "part": part, "chunk": chunk, **lane}

    def _own(self, chunk: int) -> int:
        """The first chunk of this lane from ``chunk`` on."""
        return chunk + (self.lane - chunk) % self.lanes

    def _resumed(self) -> dict:
        """The newest offset in the checkpoint's log, if this query has planned one."""
        if self.checkpoint:
            system, folder = located(f"{self.checkpoint}/offsets")
            if system.get_file_info(folder).type == fs.FileType.Directory:
                logs = [e for e in system.get_file_info(fs.FileSelector(folder)) if e.base_name.isdigit()]
                for log in sorted(logs, key=lambda e: -int(e.base_name)):
                    with system.open_input_stream(log.path) as lines:
                        for line in lines.read().decode().splitlines():
                            if line.startswith("{") and (offset := json.loads(line)).get("index") == self.index:
                                if (was := (offset.get("lane", 0), offset.get("lanes", 1))) != (self.lane, self.lanes):
                                    raise ValueError(f"the checkpoint is that of lane {was[0]} of {was[1]}")
                                return offset
        return self.initialOffset()

    def _part(self, number: int) -> list[tuple[str, int, int]]:
        """The chunks of a part of the index, which is held until the next one is read."""
        system, folder = located(self.index)
        if len(self.parts) <= number:
            self.parts = _parts(system, folder)
        if len(self.parts) <= number:
            return []
        if getattr(self, "_held", (None,))[0] != number:
            table = ds.dataset(f"{folder}/{self.parts[number]}", filesystem=system, format="parquet").to_table(columns=["modified", "file", "byte", "end"])
            table = table.sort_by([("modified", "ascending"), ("file", "ascending"), ("byte", "ascending")])
            self._held = (number, list(zip(*(table[c].to_pylist() for c in ("file", "byte", "end")), strict=True)))
        return self._held[1]

    def latestOffset(self) -> dict:
        """One chunk further than the last, if there is one."""
        at = self.planned or self._resumed()
        part, chunk = at["part"], self._own(at["chunk"])
        while chunk >= len(self._part(part)):
            if part + 1 >= len(self.parts):
                self.planned = at
                return at
            part, chunk = part + 1, self._own(0)
        file, _, end = self._part(part)[chunk]
        self.planned = self._offset(file, end, part, chunk + 1)
        return self.planned

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        found = []
        for part in range(start["part"], end["part"] + 1):
            listed = self._part(part)
            begin_at = self._own(start["chunk"] if part == start["part"] else 0)
            listed = listed[begin_at : end["chunk"] if part == end["part"] else None : self.lanes]
            for file, begin, stop in listed:
                found += [Chunk(file, a, min(a + self.range_bytes, stop)) for a in range(begin, stop, self.range_bytes)]
        return found

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        system, path = located(partition.file)
        with system.open_input_file(path) as source:
            held, size = [], 0
            for line in lines_between(source, source.size(), partition.begin, partition.end):
                held.append(line.removesuffix(b"\r"))
                size += len(line) + 16
                if size >= BATCH_BYTES:
                    yield _batch(partition.file, held)
                    held, size = [], 0
            if held:
                yield _batch(partition.file, held)

    def commit(self, end: dict) -> None:
        pass


def _batch(file: str, lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file] * len(lines)), pa.array(lines, pa.binary())], names=["file", "value"])


class BoundedLines(DataSource):
    """Streaming lines (file, value) by an index of `index_lines`; options: index, checkpoint (that of the query), lane and lanes."""

    @classmethod
    def name(cls) -> str:
        return "bounded_lines"

    def schema(self) -> str:
        return "file string, value binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


def stream_bounded(spark: SparkSession, index: str, checkpoint: str, **options: str) -> DataFrame:
    """The indexed lines as (file, value); start the query with this ``checkpoint`` as its checkpointLocation."""
    spark.dataSource.register(BoundedLines)
    reader = spark.readStream.format("bounded_lines").options(index=index, checkpoint=checkpoint, **options)
    return reader.load().withColumn("value", F.col("value").cast("string"))


def stream_lanes(spark: SparkSession, index: str, checkpoint: str, chunks: int, **options: str) -> list[tuple[DataFrame, str]]:
    """The indexed lines as streams (file, value), each with its own checkpoint below ``checkpoint``.

    There are as many as cores, MAX_LANES and ``chunks`` allow. A run that goes on must ask for as many again.
    """
    lanes = max(1, min(spark.sparkContext.defaultParallelism, MAX_LANES, chunks))
    places = [f"{checkpoint}/lane-{lane}" for lane in range(lanes)]
    return [(stream_bounded(spark, index, p, lane=str(i), lanes=str(lanes), **options), p) for i, p in enumerate(places)]


def finish(*queries: StreamingQuery) -> None:
    """Wait until everything indexed is processed, then stop."""
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
