"""Reading ticket files: tolerant lines, exports, compressed files, file trees."""

from __future__ import annotations

import bz2
import csv
import gzip
import importlib.util
import io
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fields import EXPORT_COLUMNS, MISSING_MARKERS, blank_to_null
from ..functions.jsonl import json_verdict
from . import encodings, xz
from .ranges import byte_ranges, list_files, located, named, spread_ranges

# Directories that never hold project sources.
IGNORED_DIRECTORIES = (".venv", "venv", "__pycache__", ".git", "node_modules")
_BATCH_LINES = 10_000
_HEAD_BYTES = 1 << 16


def _foreign(name: Column) -> Column:
    """Compressed files that Spark's text reader does not open by their suffix."""
    return name.rlike(r"(?i)\.(gz|bz2|xz)$") & ~name.rlike(r"\.(gz|bz2)$")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of plain, ``.gz`` and ``.bz2`` files as ``(file, value)``.

    Plain and ``.bz2`` files are split. A ``.gz`` file is one task: repartition
    after the scan when a few large ones feed heavy work. ``.xz`` (and ``.GZ``) files
    would come back as raw bytes: the job fails when a path or folder holds one; see
    `read_compressed`.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    if any(p.lower().endswith(".xz") for p in listed):
        raise ValueError("read .xz files with read_compressed")
    name = F.col("_metadata.file_path")
    refused = F.raise_error(F.concat(F.lit("read this file with read_compressed: "), name)).cast("boolean")
    lines = spark.read.text(listed).filter(F.when(_foreign(name), refused).otherwise(F.lit(True)))
    return lines.select(name.alias("file"), "value")


_OPENERS = {".gz": gzip.open, ".bz2": bz2.open}


def _opened_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines as bytes: whether they are text is for the line's verdict to say."""
    for batch in batches:
        for name in batch.column(0).to_pylist():
            opener = _OPENERS["." + name.lower().rsplit(".", 1)[1]]
            system, path = located(name)
            with system.open_input_file(path) as packed, opener(packed, "rb") as lines:
                while held := [line.rstrip(b"\n").removesuffix(b"\r") for line in islice(lines, _BATCH_LINES)]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(held)), pa.array(held, pa.binary())], names=["file", "value"]
                    )


def read_compressed(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every file below a folder, opened by suffix in any case.

    Spark's own codecs read ``.gz``, ``.bz2`` and plain files. The suffixes
    they do not know are opened in the tasks instead: ``.xz`` by blocks, a
    task each, and ``.GZ`` or ``.BZ2`` as one stream a file.
    """
    # The filter is on the file's own metadata, so the text scan does not open the other files.
    name = F.col("_metadata.file_path")
    native = spark.read.option("recursiveFileLookup", True).text(path).filter(~_foreign(name))
    listed = _visible(list_files(spark, path), path).filter(_foreign(F.col("file"))).select("file", "size")
    by_block = F.lower("file").endswith(".xz")
    whole = listed.filter(~by_block).withColumn("begin", F.lit(0))
    lines = spread_ranges(whole).select("file").mapInArrow(_opened_lines, "file string, value binary")
    lines = lines.unionByName(xz.read_xz(listed.filter(by_block)))
    return native.select(_file_name().alias("file"), "value").unionByName(lines.withColumn("value", F.col("value").cast("string")))


def decoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``(file, value)`` of plain files, each read in the encoding `file_encoding_report` finds, UTF-16 too."""
    return encodings.lines_in_encodings(list_files(spark, path))


def _widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many columns a file's header has, from as much of its begin as holds the first record."""
    for batch in batches:
        widths = []
        for name in batch.column(0).to_pylist():
            system, path = located(name)
            with system.open_input_file(path) as source:
                head, more = b"", True
                while more:
                    more = source.read(_HEAD_BYTES)
                    head += more
                    # An even number of quotes before the line feed: the record is whole.
                    feed = head.find(b"\n")
                    while feed >= 0 and head.count(b'"', 0, feed) % 2:
                        feed = head.find(b"\n", feed + 1)
                    if feed >= 0:
                        head = head[:feed]
                        break
            widths.append(len(next(csv.reader(io.StringIO(head.decode(errors="replace"), newline="")), [])))
        yield pa.RecordBatch.from_arrays([pa.array(widths, pa.int32())], names=["width"])


def _own_headers(width: int):
    """Rows under the six fields by the header of their own file, which is its first row."""

    def fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, places = None, {}
        for batch in batches:
            files = batch.column(width)
            numbers = files.dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if files[begin].as_py() != current:
                    current = files[begin].as_py()
                    header = [batch.column(i)[begin].as_py() for i in range(width)]
                    header[0] = (header[0] or "").removeprefix("\ufeff")
                    places = {}
                    for i, name in enumerate(header):
                        places.setdefault(name, i)
                    begin += 1
                rows = batch.slice(begin, end - begin)
                missing = pa.nulls(rows.num_rows, pa.string())
                picked = [rows.column(places[h]) if h in places else missing for h in EXPORT_COLUMNS.values()]
                yield pa.RecordBatch.from_arrays(picked, names=list(EXPORT_COLUMNS))

    return fields


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """A tabular export (CSV with a header) as the six nullable ticket fields.

    Files may differ in the order and choice of columns: each is read under its own first
    record. Of columns with one name the first is taken; a missing column is null. One scan
    over all files, a task a file, since a record may span lines; before it only the first
    record of each file is read, for the number of columns.
    """
    heads = _visible(list_files(spark, path), path).filter("size > 0").withColumn("begin", F.lit(0))
    width = spread_ranges(heads.select("file", "begin")).select("file").mapInArrow(_widths, "width int").agg(F.max("width")).first()[0]
    fields = ", ".join(f"{name} string" for name in EXPORT_COLUMNS)
    if not width:
        return spark.createDataFrame([], fields)
    columns = ", ".join(f"c{i} string" for i in range(width))
    raw = spark.read.options(header=False, multiLine=True, escape='"', recursiveFileLookup=True).schema(columns).csv(path)
    read = raw.withColumn("__file", F.col("_metadata.file_path")).mapInArrow(_own_headers(width), fields)
    return read.select(*[blank_to_null(F.col(n), MISSING_MARKERS).alias(n) for n in EXPORT_COLUMNS])


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Spreadsheet workbooks, one task per file. Needs an Excel reader on the executors."""
    if importlib.util.find_spec("openpyxl") is None:
        raise RuntimeError("reading workbooks needs openpyxl; export to CSV instead")
    headers = dict(EXPORT_COLUMNS)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                sheet = pd.read_excel(io.BytesIO(content), dtype=str)
                picked = {f: sheet.get(h, pd.Series([None] * len(sheet))) for f, h in headers.items()}
                yield pd.DataFrame(picked).astype(object).where(lambda x: x.notna(), None)

    schema = ", ".join(f"{name} string" for name in EXPORT_COLUMNS)
    cells = (
        spark.read.option("pathGlobFilter", "*.xlsx").format("binaryFile").load(path)
        .select("content").mapInPandas(parse, schema)
    )
    return cells.select(*[blank_to_null(F.col(n)).alias(n) for n in EXPORT_COLUMNS])


def _file_name() -> Column:
    """The name of the file a scan's row comes from, as `list_files` writes it: Spark's scans escape it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _prefix(root: str) -> str:
    """What the names of files below ``root`` begin with."""
    return named(root, located(root)[1].rstrip("/")) + "/"


def _visible(files: DataFrame, root: str) -> DataFrame:
    """Files that Spark's scans of a folder read: no part of their path below it begins with a dot or underscore."""
    below = F.substring("file", len(_prefix(root)), 1 << 30)
    return files.filter(~below.rlike(r"/[._][^/]*"))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name in batch.column(0).to_pylist():
            system, path = located(name)
            with system.open_input_stream(path) as source:
                text = source.read().decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text])], names=["file", "content"])


def _border(source: pa.NativeFile, at: int) -> int:
    """Where a character begins at or after a byte: past the at most three bytes that may go on with one before it."""
    if at == 0:
        return at
    source.seek(at)
    following = source.read(3)
    return at + next((i for i, byte in enumerate(following) if byte & 0xC0 != 0x80), len(following))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
            system, path = located(name)
            with system.open_input_file(path) as source:
                first, last = _border(source, begin), _border(source, end)
                source.seek(first)
                text = source.read(max(0, last - first)).decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([begin]), pa.array([text])], names=["file", "begin", "content"])


def discover_files(
    spark: SparkSession,
    root: str,
    glob: str = "*.py",
    ignored: Iterable[str] = IGNORED_DIRECTORIES,
    piece: int | None = None,
) -> DataFrame:
    """Whole files below ``root`` as ``(path, content)``, path relative to the root.

    The root may itself stand in an ignored folder: only those below it are passed over.
    Names are dealt to the tasks, which read the files. A row holds a whole file; with
    ``piece`` it holds about so many bytes, ``(path, begin, content)``, whose contents in
    the order of ``begin`` are the file's: for files too large for a row. An empty file
    is one empty piece.
    """
    files = list_files(spark, root, glob, ignored)
    prefix = len(_prefix(root))
    below = F.substring("file", prefix + 1, 1 << 30).alias("path")
    if piece is None:
        dealt = spread_ranges(files.withColumn("begin", F.lit(0)).select("file", "begin")).select("file")
        return dealt.mapInArrow(_contents, "file string, content string").select(below, "content")
    empty = files.filter("size = 0").select("file", F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("end"))
    ranges = byte_ranges(files, piece).select("file", "begin", "end").unionByName(empty)
    return spread_ranges(ranges).mapInArrow(_pieces, "file string, begin long, content string").select(below, "begin", "content")


def file_encoding_report(spark: SparkSession, path: str) -> DataFrame:
    """Which encoding reads each file: UTF-8 when it is valid, else a fixed candidate list, judged by byte ranges."""
    return encodings.encoding_report(spark, path)


_SPLIT_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("lines", T.LongType()),
        T.StructField("bad_lines", T.LongType()),
        T.StructField("first_bad", T.LongType()),
    ]
)


def _split_summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one file block arrive together and in order: one summary per block."""
    seen: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, start, bad in zip(batch["file"], batch["block_start"], batch["bad"]):
            entry = seen.setdefault((file, start), [0, 0, None])
            entry[0] += 1
            if bad:
                entry[1] += 1
                entry[2] = entry[2] or entry[0]
    rows = [(f, s, *entry) for (f, s), entry in seen.items()]
    frame = pd.DataFrame(rows, columns=[x.name for x in _SPLIT_SCHEMA.fields])
    yield frame.astype({"first_bad": "Int64"})


def file_integrity(spark: SparkSession, path: str) -> DataFrame:
    """Per file: ``is_valid`` and the number of its first undecodable line.

    Line numbers need file order but not whole files: each block is counted
    where it is read, and the few block counts of a file are then added up.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        _file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        json_verdict(F.col("value"), strip_line=False, dump=False)["verdict"].alias("verdict"),
    )
    flagged = lines.select("file", "block_start", (~F.col("verdict").isin("ok", "blank")).alias("bad"))
    blocks = flagged.mapInPandas(_split_summaries, _SPLIT_SCHEMA)
    before = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("offset", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    scanned = placed.groupBy("file").agg(
        (F.sum("bad_lines") == 0).alias("is_valid"),
        F.min(F.col("offset") + F.col("first_bad")).alias("first_bad_line"),
    )
    # A file without lines is valid.
    return _visible(list_files(spark, path), path).select("file").join(scanned, "file", "left").withColumn(
        "is_valid", F.coalesce("is_valid", F.lit(True))
    )
