"""Splitting many texts at once into chunks, each distinct chunk handled once.

Bytes are classed (white space, plain Latin letters, other plain characters, all
the rest) and a text is cut where two neighbouring classes are in ``cuts``. White
space stays at the front of the chunk after it. Chunks become codes into the
distinct chunks of the slice, so that Python sees each distinct chunk only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE, LETTER, PLAIN, REST = range(4)
ASCII_SPACES = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 2 << 20  # texts are taken in slices of about this size


class Chunks(NamedTuple):
    values: pa.StringArray  # the distinct chunks
    codes: np.ndarray  # of all chunks of all texts, in order
    bounds: np.ndarray  # text i has the chunks bounds[i] up to bounds[i + 1]


def _kinds(spaces: bytes, apart: bytes) -> np.ndarray:
    kinds = np.full(256, REST, np.uint8)
    kinds[:128] = PLAIN
    for first, last in ("AZ", "az"):
        kinds[ord(first) : ord(last) + 1] = LETTER
    kinds[0x80:0xC0] = LETTER  # second bytes; those of REST characters are set below
    kinds[0xC3:0xC6] = LETTER  # first bytes of U+00C0 to U+017F
    kinds[list(apart)] = REST
    kinds[list(spaces)] = SPACE
    return kinds


def classes(data: np.ndarray, spaces: bytes, apart: bytes = b"") -> np.ndarray:
    """The class of each byte of UTF-8 text; REST also for U+00D7, U+00F7, U+0130 and the plain characters ``apart``."""
    found = _kinds(spaces, apart)[data]
    if not len(data) or data.max() < 0xC2:
        return found
    first = np.flatnonzero((data >= 0xC2) & ((data < 0xC3) | (data > 0xC5)))
    second = data[np.minimum(np.arange(len(data)) + 1, len(data) - 1)] if (data == 0xC3).any() or (data == 0xC4).any() else None
    if second is not None:
        odd = ((data == 0xC3) & ((second == 0x97) | (second == 0xB7))) | ((data == 0xC4) & (second == 0xB0))
        first = np.concatenate([first, np.flatnonzero(odd)])
    found[first] = REST
    for more, least in ((1, 0xC2), (2, 0xE0), (3, 0xF0)):
        found[first[data[first] >= least] + more] = REST
    return found


def plain_letters(text: str) -> bool:
    """Whether ``text`` has no character of class REST."""
    return text.isascii() or not (classes(np.frombuffer(text.encode(), np.uint8), b" ") == REST).any()


def split(texts: pa.Array, spaces: bytes, cuts: tuple[tuple[int, int], ...], apart: bytes = b"") -> Chunks:
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
    starts = offsets - offsets[0]
    table = np.zeros((4, 4), bool)
    for pair in cuts:
        table[pair] = True
    found = classes(data, spaces, apart)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = table.ravel()[found[:-1] * 4 + found[1:]] if len(data) else False
    cut[starts] = True
    at = np.flatnonzero(cut).astype(np.int32)
    bounds = np.searchsorted(at, starts)
    chunks = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))
    coded = chunks.dictionary_encode()
    return Chunks(coded.dictionary, coded.indices.to_numpy(), bounds)


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about SLICE_BYTES; a longer text is a slice of its own."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield texts.slice(at, end - at)
        at = end


def sums(values: np.ndarray, chunks: Chunks) -> np.ndarray:
    """Per text, the sum of a number given for each distinct chunk."""
    total = np.concatenate([[0], np.cumsum(values[chunks.codes])])
    return total[chunks.bounds[1:]] - total[chunks.bounds[:-1]]


def strung(values: list[bytes], chunks: Chunks) -> Iterator[memoryview]:
    """Per text, what is given for its chunks, joined."""
    taken = pa.array(values, pa.large_binary()).take(pa.array(chunks.codes))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    data = memoryview(taken.buffers()[2] or b"")
    for a, b in zip(chunks.bounds[:-1], chunks.bounds[1:], strict=True):
        yield data[offsets[a] : offsets[b]]
