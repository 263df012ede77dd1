"""Which encoding reads a file, and its lines in that encoding, both by byte range.

Whether bytes are UTF-8 is said by an automaton of nine states. A range does not know the
state it begins in, so it reports for each state the state it ends in; a file's reports
are composed in order. UTF-16 with a byte order mark is checked alike, by what may follow
half a surrogate pair. So a file of any size is judged by as many tasks as it has ranges.

Defined cases: an empty file is UTF-8; UTF-16 is believed only with its mark, and if it has
whole units and pairs; bytes that are neither are cp1252 if none of its five unused bytes
occurs, else latin-1, which reads anything.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranges import RANGE_BYTES, byte_ranges, lines_between, list_files, located, pieces, spread_ranges

# Bytes that cp1252 leaves undefined.
UNUSED_1252 = bytes([0x81, 0x8D, 0x8F, 0x90, 0x9D])

# States of the automaton: between characters, so many bytes to come, and the lead bytes after which not all are allowed.
DONE, ONE, TWO, THREE, AFTER_E0, AFTER_ED, AFTER_F0, AFTER_F4, BROKEN = range(9)
_LEADS = ((0x00, 0x7F, DONE), (0xC2, 0xDF, ONE), (0xE0, 0xE0, AFTER_E0), (0xE1, 0xEC, TWO), (0xED, 0xED, AFTER_ED), (0xEE, 0xEF, TWO))
_LEADS += ((0xF0, 0xF0, AFTER_F0), (0xF1, 0xF3, THREE), (0xF4, 0xF4, AFTER_F4))
_FOLLOWING = {
    ONE: (0x80, 0xBF, DONE),
    TWO: (0x80, 0xBF, ONE),
    THREE: (0x80, 0xBF, TWO),
    AFTER_E0: (0xA0, 0xBF, ONE),
    AFTER_ED: (0x80, 0x9F, ONE),
    AFTER_F0: (0x90, 0xBF, TWO),
    AFTER_F4: (0x80, 0x8F, TWO),
}


def step(state: int, byte: int) -> int:
    if state == DONE:
        return next((to for low, high, to in _LEADS if low <= byte <= high), BROKEN)
    low, high, to = _FOLLOWING.get(state, (1, 0, BROKEN))
    return to if low <= byte <= high else BROKEN


def utf8_ends(data: Iterator[bytes]) -> list[int]:
    """The state after some bytes, for each state before them.

    From any state the automaton is done or broken after three bytes at most; from where it
    is done the rest is read by the library's decoder, once for each such place.
    """
    data = iter(data)
    head = b""
    for some in data:
        head += some
        if len(head) >= 3:
            break
    begins: dict[int, list[int]] = {}  # states that are done after so many bytes
    ends = [BROKEN] * 9
    for state in range(BROKEN):
        reached, at = state, 0
        while reached not in (DONE, BROKEN) and at < len(head):
            reached, at = step(reached, head[at]), at + 1
        if reached == DONE:
            begins.setdefault(at, []).append(state)
        else:
            ends[state] = reached
    decoders = {at: codecs.getincrementaldecoder("utf-8")() for at in begins}

    def fed(some: bytes, skip: bool) -> None:
        for at, decoder in list(decoders.items()):
            try:
                decoder.decode(some[at:] if skip else some)
            except UnicodeDecodeError:
                del decoders[at]

    fed(head, True)
    for some in data:
        if not decoders:
            break
        fed(some, False)
    for at, decoder in decoders.items():
        reached = DONE
        for byte in decoder.getstate()[0]:
            reached = step(reached, byte)
        for state in begins[at]:
            ends[state] = reached
    return ends


WHOLE, HALF, TORN = range(3)  # between characters, after the first half of a pair, invalid


def utf16_ends(data: Iterator[bytes], little: bool) -> list[int]:
    """As `utf8_ends` for UTF-16, over pieces of whole units but for the last."""
    ends = [WHOLE, HALF, TORN]
    for some in data:
        if len(some) % 2:
            return [TORN] * 3
        kinds = np.frombuffer(some, "<u2" if little else ">u2") & 0xFC00
        high, low = kinds == 0xD800, kinds == 0xDC00
        after = HALF if high[-1] else WHOLE
        fits = bool((low[1:] == high[:-1]).all())
        ends = [after if x != TORN and fits and low[0] == (x == HALF) else TORN for x in ends]
    return ends


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, begin, end in _rows(batches):
        system, path = located(file)
        plain, mark = True, b""

        def passed(data: Iterator[bytes]) -> Iterator[bytes]:
            nonlocal plain, mark
            for some in data:
                plain = plain and len(some.translate(None, UNUSED_1252)) == len(some)
                mark = mark or some[:2]
                yield some

        with system.open_input_file(path) as source:
            data = passed(pieces(source, begin, end))
            ends = utf8_ends(data)
            for _ in data:  # what the automaton left, once it was broken
                pass
        columns = ([file], [begin], [ends], [plain], [mark if begin == 0 else b""])
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "begin", "ends", "plain", "mark"])


def _judge_wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, begin, end, mark in _rows(batches):
        system, path = located(file)
        with system.open_input_file(path) as source:
            ends = utf16_ends(pieces(source, begin, end), mark == codecs.BOM_UTF16_LE)
        columns = ([file], [begin], [ends])
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "begin", "ends"])


def _composed(ranges: str) -> str:
    """SQL for the state a file ends in: its ranges' maps applied in order, from state 0."""
    return f"aggregate(array_sort({ranges}), 0, (state, r) -> r.ends[state])"


def file_encodings(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, encoding, valid_utf8, mark) of files (file, size); ``mark`` is the byte order mark of UTF-16."""
    ranges = byte_ranges(files, range_bytes - range_bytes % 2).select("file", "begin", "end")
    judged = spread_ranges(ranges).mapInArrow(_judge, "file string, begin long, ends array<int>, plain boolean, mark binary")
    narrow = judged.groupBy("file").agg(
        F.collect_list(F.struct("begin", "ends")).alias("ranges"), F.min("plain").alias("plain"), F.max("mark").alias("mark")
    )
    narrow = narrow.select("file", F.expr(f"{_composed('ranges')} = {DONE}").alias("narrow"), "plain", "mark")
    marked = F.col("mark").isin(codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)
    found = files.select("file").join(narrow, "file", "left").withColumn("mark", F.when(marked & ~F.col("narrow"), F.col("mark")))
    wide = spread_ranges(ranges.join(found.filter("mark IS NOT NULL").select("file", "mark"), "file"))
    wide = wide.mapInArrow(_judge_wide, "file string, begin long, ends array<int>")
    wide = wide.groupBy("file").agg(F.collect_list(F.struct("begin", "ends")).alias("ranges"))
    wide = wide.select("file", F.expr(f"{_composed('ranges')} = {WHOLE}").alias("wide"))
    valid = F.coalesce("narrow", F.lit(True))
    encoding = F.when(valid, "utf-8").when(F.col("wide"), "utf-16").when(F.col("plain"), "cp1252").otherwise("latin-1")
    return found.join(wide, "file", "left").select("file", encoding.alias("encoding"), valid.alias("valid_utf8"), F.when(F.col("wide"), F.col("mark")).alias("mark"))


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, size, begin, end, encoding, mark in _rows(batches):
        system, path = located(file)
        if encoding == "utf-16":
            encoding = "utf-16-le" if mark == codecs.BOM_UTF16_LE else "utf-16-be"
        held, chars = [], 0
        with system.open_input_file(path) as source:
            for i, line in enumerate(lines_between(source, size, begin, end, "\n".encode(encoding))):
                text = line.decode(encoding).removesuffix("\r")
                held.append(text.removeprefix("﻿") if i == begin == 0 and mark else text)
                chars += len(text) + 16
                if chars >= 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(held)), pa.array(held, pa.string())], names=["file", "value"])
                    held, chars = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(held)), pa.array(held, pa.string())], names=["file", "value"])


def lines_in_encodings(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines (file, value) of files (file, size), each read in its encoding, range by range."""
    ranges = byte_ranges(files, range_bytes - range_bytes % 2)
    known = file_encodings(files, range_bytes).select("file", "encoding", "mark")
    wanted = ranges.join(known, "file").select("file", "size", "begin", "end", "encoding", "mark")
    return spread_ranges(wanted).mapInArrow(_read_lines, "file string, value string")


def encoding_report(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, encoding, valid_utf8) of every file below ``path``."""
    found = file_encodings(list_files(spark, path), range_bytes)
    return found.select(F.col("file").alias("path"), "encoding", "valid_utf8")
