"""Large ``.xz`` files read in as many tasks as they have blocks.

The end of a file lists its blocks: how long each is, packed and unpacked. A task unpacks
one block by itself, after the file's header, and reads the lines that begin in it; the
last of them is read on in the blocks that follow, up to its end. As usual for split
lines, a task but the first passes over what comes before its first line feed, and goes on
to the first line feed of the next block, so no line is read twice.

Defined cases: several streams in one file, padding between them, blocks without a line
feed and empty streams are read as the library reads them; a file whose index is broken
fails the job, as bytes that cannot be unpacked do.
"""

from __future__ import annotations

import lzma
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .ranges import located, spread_ranges

# The magic bytes and sizes of the format.
FOOTER_MAGIC, HEADER_BYTES, FOOTER_BYTES = b"YZ", 12, 12
_READ = 1 << 20
_BATCH = 1 << 20


def _number(data: bytes, at: int) -> tuple[int, int]:
    """An integer of seven bits a byte, and where it ends."""
    value = shift = 0
    while True:
        value |= (data[at] & 0x7F) << shift
        if data[at] < 0x80:
            return value, at + 1
        at, shift = at + 1, shift + 7


def blocks(source: pa.NativeFile, size: int) -> list[tuple[int, int, int]]:
    """(stream header, begin, end) of the blocks in file order, as bytes of the file."""
    found: list[tuple[int, int, int]] = []
    end = size
    while end > 0:
        source.seek(end - FOOTER_BYTES)
        footer = source.read(FOOTER_BYTES)
        if footer[-4:] == bytes(4):  # padding goes by four bytes
            end -= 4
            continue
        if footer[-2:] != FOOTER_MAGIC:
            raise lzma.LZMAError(f"no .xz stream ends at byte {end}")
        index_size = (int.from_bytes(footer[4:8], "little") + 1) * 4
        source.seek(end - FOOTER_BYTES - index_size)
        index = source.read(index_size)
        count, at = _number(index, 1)
        sizes = []
        for _ in range(count):
            unpadded, at = _number(index, at)
            _, at = _number(index, at)
            sizes.append(-(-unpadded // 4) * 4)
        begin = end - FOOTER_BYTES - index_size - sum(sizes)
        header = begin - HEADER_BYTES
        mine = []
        for length in sizes:
            mine.append((header, begin, begin + length))
            begin += length
        found = mine + found
        end = header
    return found


def unpacked(source: pa.NativeFile, block: tuple[int, int, int]) -> Iterator[bytes]:
    """The bytes of one block, some at a time."""
    header, begin, end = block
    source.seek(header)
    decoder = lzma.LZMADecompressor(lzma.FORMAT_XZ)
    decoder.decompress(source.read(HEADER_BYTES))
    while begin < end:
        source.seek(begin)
        data = source.read(min(_READ, end - begin))
        begin += len(data)
        out = decoder.decompress(data, _READ)
        while out or not decoder.needs_input:
            if out:
                yield out
            out = decoder.decompress(b"", _READ)
        if not data:
            raise lzma.LZMAError("a block ends before its length")


def block_lines(source: pa.NativeFile, listed: list[tuple[int, int, int]], number: int) -> Iterator[bytes]:
    """The lines of a block of a file, without their line feeds."""
    held = bytearray()
    skipping = number > 0
    for i in range(number, len(listed)):
        for data in unpacked(source, listed[i]):
            begin = len(held)
            held += data
            while (feed := held.find(b"\n", begin)) >= 0:
                if not skipping:
                    yield bytes(held[:feed])
                del held[: feed + 1]
                if i > number:
                    return
                skipping, begin = False, 0
            if skipping:
                held.clear()
        if skipping:
            return
    if held:
        yield bytes(held)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, size in zip(*(batch.column(n).to_pylist() for n in ("file", "size")), strict=True):
            system, path = located(file)
            with system.open_input_file(path) as source:
                count = len(blocks(source, size))
            yield pa.RecordBatch.from_arrays([pa.array([file] * count, pa.string()), pa.array([size] * count, pa.int64()), pa.array(range(count), pa.int64())], names=["file", "size", "begin"])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, size, number in zip(*(batch.column(n).to_pylist() for n in ("file", "size", "begin")), strict=True):
            system, path = located(file)
            with system.open_input_file(path) as source:
                held, length = [], 0
                for line in block_lines(source, blocks(source, size), number):
                    held.append(line.removesuffix(b"\r"))
                    length += len(line) + 16
                    if length >= _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array([file] * len(held)), pa.array(held, pa.binary())], names=["file", "value"])
                        held, length = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(held)), pa.array(held, pa.binary())], names=["file", "value"])


def read_xz(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Lines (file, value as bytes) of ``.xz`` files (file, size); a row, and so a piece of work, is a block."""
    numbered = files.select("file", "size").mapInArrow(_listed, "file string, size long, begin long")
    return spread_ranges(numbered, tasks).mapInArrow(_lines, "file string, value binary")
