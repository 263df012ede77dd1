"""Files listed and read by the tasks: folders level by level, files by byte range.

Nothing per file reaches the driver. Names are URIs; the tasks open them through Arrow's
file systems (local, HDFS and the object stores it knows), so a range of a large file is
read without the rest of it.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from fnmatch import fnmatchcase
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_folder

RANGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
FOLDERS_A_TASK = 64


@lru_cache(64)
def _system(scheme_and_host: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(f"{scheme_and_host}/x")[0]


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a name and its path there. A name without a scheme is a local path, taken as it is."""
    scheme, found, rest = uri.partition(":/")
    if not found or "/" in scheme:
        return _system("file://"), os.path.abspath(uri)
    if scheme == "file":
        return _system("file://"), "/" + rest.lstrip("/")
    host, _, path = rest.lstrip("/").partition("/")
    system = _system(f"{scheme}://{host}")
    return system, path if scheme.startswith("hdfs") and path.startswith("/") else f"{'/' if scheme == 'hdfs' else host + '/'}{path}"


def named(like: str, path: str) -> str:
    """The name of a path on the file system of ``like``, with one slash after the scheme as Spark writes local files."""
    scheme, found, rest = like.partition(":/")
    if not found or "/" in scheme or scheme == "file":
        return f"file:{path}"
    host = rest.lstrip("/").partition("/")[0]
    return f"{scheme}://{host}{path}" if path.startswith("/") else f"{scheme}://{path}"


_ENTRIES = pa.schema([("file", pa.string()), ("folder", pa.bool_()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])


def _entries(names: Iterable[str], glob: str, ignored: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The folders in folders, and the files that are called like ``glob``; a name that is a file is listed itself."""
    held: list[tuple] = []
    for name in names:
        system, path = located(name)
        (info,) = system.get_file_info([path])
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=False))
        for x in found:
            folder = x.type == fs.FileType.Directory
            if x.base_name in ignored if folder else not fnmatchcase(x.base_name, glob):
                continue
            held.append((named(name, x.path), folder, x.size or 0, x.mtime))
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ENTRIES)], schema=_ENTRIES)
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ENTRIES)], schema=_ENTRIES)


def list_files(spark: SparkSession, root: str, glob: str = "*", ignored: Iterable[str] = ()) -> DataFrame:
    """Files below ``root`` as (file, size, modified), breadth first: the folders of a level are listed by tasks.

    ``root`` may be one file. Folders called as ``ignored`` are not entered. Each level is
    written to the run's folder; the driver learns only whether there is a next one.
    """
    ignored = tuple(ignored)
    below = run_folder(spark, "listing")
    begin = located(root)[1].rstrip("/") or "/"
    frontier = spark.createDataFrame([(named(root, begin),)], "file string")
    level, folders = 0, 1
    while folders:
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _entries(batch.column(0).to_pylist(), glob, ignored)

        dealt = frontier.repartition(max(1, min(-(-folders // FOLDERS_A_TASK), 10_000)))
        entries = dealt.mapInArrow(listed, "file string, folder boolean, size long, modified timestamp")
        entries.write.parquet(f"{below}/level={level}")
        frontier = spark.read.schema("file string, folder boolean").parquet(f"{below}/level={level}").filter("folder").select("file")
        folders, level = frontier.count(), level + 1
    found = spark.read.schema("file string, folder boolean, size long, modified timestamp, level int").parquet(below)
    return found.filter("NOT folder").select("file", "size", "modified")


def byte_ranges(files: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """(file, size, begin, end): each file cut into ranges of ``size`` bytes; an empty file has none."""
    begins = F.explode(F.when(F.col("size") > 0, F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(size).cast("long"))))
    cut = files.select("file", "size", begins.alias("begin"))
    return cut.withColumn("end", F.least(F.col("begin") + size, F.col("size")))


def spread_ranges(ranges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Ranges dealt out evenly: a few rows each stand for much work."""
    return ranges.repartition(tasks or ranges.sparkSession.sparkContext.defaultParallelism * 4, "file", "begin")


def pieces(source: pa.NativeFile, begin: int, end: int, size: int = READ_BYTES) -> Iterator[bytes]:
    """The bytes of a range, some at a time."""
    source.seek(begin)
    while begin < end:
        data = source.read(min(size, end - begin))
        if not data:
            return
        begin += len(data)
        yield data


def _ends(data: bytearray, at: int, newline: bytes) -> int:
    """Where the first newline at or after ``at`` ends, on its unit's border; 0 for none."""
    unit = len(newline)
    while (found := data.find(newline, at)) >= 0:
        if found % unit == 0:
            return found + unit
        at = found + 1
    return 0


def lines_between(source: pa.NativeFile, size: int, begin: int, end: int, newline: bytes = b"\n") -> Iterator[bytes]:
    """Lines that begin at or after ``begin`` and before ``end``, without their ends, in file order.

    ``begin`` and ``end`` need not lie on line borders: each line belongs to the range it
    begins in, and is read to its end beyond it. With a newline of two bytes they must be even.
    """
    unit = len(newline)
    skipping = begin > 0
    place = begin - unit if skipping else 0  # a newline right before the range ends the line before
    held, seen = bytearray(), 0  # bytes from place on, and how many of them hold no newline
    for data in pieces(source, place, size):
        held += data
        cut = 0
        while skipping or place + cut < end:
            stop = _ends(held, max(cut, seen), newline)
            if not stop:
                seen = len(held) - len(held) % unit
                break
            if not skipping:
                yield bytes(held[cut : stop - unit])
            skipping, cut = False, stop
        else:
            return
        place, seen = place + cut, max(0, seen - cut)
        del held[:cut]
        if skipping:
            if place + seen >= end:
                return
            place, seen = place + seen, 0
            del held[: len(held) - len(held) % unit]
    if held and not skipping and place < end:
        yield bytes(held)
