"""Packing tokenised documents into sequences by the sum-of-squares rule.

A document's ids, with the end id after them, are cut into pieces of at most
``capacity`` tokens. A piece goes into the open sequence, or a new one, that makes
the sum over all residual gaps of (number of open sequences with that gap)^2
smallest. Pieces come in a mixed order, for which the rule is meant, but the small ones
come last and longest first: they fill what is open. All longest first is tried too, and
the better placing kept. Shards of a bounded number of pieces, dealt by
hash, are packed each in one task; they differ in nothing but chance, and each
leaves at most a few sequences open.

Defined cases: a null text is an empty one and consists of the end id alone; rows
that repeat are packed each; no rows give no pieces; null keys are allowed; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import stored, text_of
from .words import ASCII_SPACES, LETTER, PLAIN, REST, SPACE, plain_letters, slices, split, strung

CAPACITY = 4096
END = 1
SHARD_PIECES = 200_000
MEMO = 100_000  # chunks whose ids a worker keeps; it starts anew when full
MEMO_CHARS = 64

# White space, and an ASCII character after a plain Latin letter, begin a new token.
CUTS = ((LETTER, SPACE), (PLAIN, SPACE), (REST, SPACE), (LETTER, PLAIN))
# Chunks are encoded many at once, with this character, a token of its own, between them.
MARK = "\x01"
PLAIN_WORD = re.compile(r"[\x20\x09-\x0D]*[a-zß-öø-įı-ňŉ-ſ]+")


class Encoder(dict):
    """Chunk to its ids, packed as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self._ids(MARK)
        # For words of plain lower-case letters, which the normaliser leaves alone and
        # which are one unit each: the same model without those steps, and the last id of a word.
        bare = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "added_tokens": []}
        steps = bare["pre_tokenizer"]["pretokenizers"]
        steps[:-1] = [{"type": "WhitespaceSplit"}]
        self.bare = Tokenizer.from_str(json.dumps(bare))
        suffix = bare["model"]["end_of_word_suffix"]
        self.last = np.zeros(self.bare.get_vocab_size(), bool)
        self.last[[i for t, i in self.bare.get_vocab().items() if t.endswith(suffix)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _words(self, words: list[str]) -> dict[str, bytes]:
        ids = np.array(self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        return self._parted(words, ids, (np.flatnonzero(self.last[ids]) + 1).tolist(), 0)

    def _marked(self, chunks: list[str]) -> dict[str, bytes]:
        ids = np.array(self._ids(f" {MARK} ".join(chunks)), "<u4")
        return self._parted(chunks, ids, [*np.flatnonzero(ids == self.mark).tolist(), len(ids)], 1)

    @staticmethod
    def _parted(chunks: list[str], ids: np.ndarray, ends: list[int], between: int) -> dict[str, bytes]:
        data, begin, found = ids.tobytes(), 0, {}
        for chunk, end in zip(chunks, ends, strict=True):
            found[chunk] = data[4 * begin : 4 * end]
            begin = end + between
        return found

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        words, others = [], []
        for chunk in chunks:
            if MARK in chunk:
                found[chunk] = np.array(self._ids(chunk), "<u4").tobytes()
            else:
                (words if PLAIN_WORD.fullmatch(chunk) else others).append(chunk)
        for some, learn in ((words, self._words), (others, self._marked)):
            for at in range(0, len(some), 2000):
                found |= learn(some[at : at + 2000])
        return found

    def encode(self, texts: pa.Array) -> Iterator[memoryview | bytes]:
        """The packed ids of each text."""
        if len(self) >= MEMO:
            self.clear()
        # The tokenizer lower-cases too; doing it first gives fewer chunks.
        lower = [t.lower() if plain_letters(t) else t for t in texts.to_pylist()]
        whole = {i for i, t in enumerate(lower) if any(s in t for s in self.special)}
        chunks = split(pa.array(["" if i in whole else t for i, t in enumerate(lower)], pa.string()), ASCII_SPACES, CUTS)
        values = chunks.values.to_pylist()
        new = self._learn([c for c in values if c not in self])
        self.update((c, ids) for c, ids in new.items() if len(c) <= MEMO_CHARS)
        for i, packed in enumerate(strung([self[c] if c in self else new[c] for c in values], chunks)):
            yield np.array(self._ids(texts[i].as_py()), "<u4").tobytes() if i in whole else packed


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, CRC-32) of packed ids."""
    size = 4 * capacity
    parts = [ids[at : at + size] for at in range(0, len(ids), size)]
    return [(i, i * capacity, len(p) // 4, zlib.crc32(p)) for i, p in enumerate(parts)]


def pieces(text: Column | str, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> Column:
    """array<struct<piece, start, length, ids_crc32[, ids]>> of a text."""
    kind = "piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    closing = np.array([end], "<u4").tobytes()

    @F.arrow_udf(f"array<struct<{kind.replace(' int', ':int').replace(' long', ':bigint').replace(' array', ':array')}>>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = encoder(path)
        for batch in batches:
            rows = []
            for texts in slices(batch):
                for packed in tables.encode(texts):
                    ids = bytes(packed) + closing
                    found = [dict(zip(("piece", "start", "length", "ids_crc32"), p, strict=True)) for p in cut(ids, capacity)]
                    if with_ids:
                        whole = np.frombuffer(ids, "<i4")
                        for p in found:
                            p["ids"] = whole[p["start"] : p["start"] + p["length"]]
                    rows.append(found)
            yield pa.array(rows, pa.list_(pa.struct(fields)))

    return split(text_of(text))


def orders(lengths: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Orders to place pieces in: those over a sixteenth mixed, then the others by length; all by length."""
    large, small = (np.flatnonzero(x) for x in (lengths > capacity // 16, lengths <= capacity // 16))
    mixed = np.random.default_rng(len(large)).permutation(large)
    return [np.concatenate([mixed, small[np.argsort(-lengths[small], kind="stable")]]), np.argsort(-lengths, kind="stable")]


def best_place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The placing with the fewest sequences: the second order wins where pieces are few."""
    return min((place(lengths, capacity, o) for o in orders(lengths, capacity)), key=lambda p: p[0].max(initial=-1))


def place(lengths: np.ndarray, capacity: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, by the sum-of-squares rule."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_ = np.zeros(capacity + 1, np.int64)  # open sequences by gap; index 0 stays 0
    members: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for at in order.tolist():
        size = int(lengths[at])
        rest = capacity - size
        if rest == 0:
            sequence[at], made = made, made + 1
            continue
        # Change of the sum for gaps size..capacity - 1: that gap loses one, the gap after it gains one.
        gaps = open_[size:capacity]
        change = np.where(gaps > 0, 2 * (open_[: len(gaps)] - gaps) + 2, np.iinfo(np.int64).max)
        if len(gaps) and gaps[0] > 0:
            change[0] = 1 - 2 * gaps[0]  # a full sequence is no longer open
        best = int(np.argmin(change)) if len(gaps) else 0
        new = 2 * open_[rest] + 1
        if len(gaps) and change[best] <= new:
            gap = size + best
            number = members[gap].pop()
            open_[gap] -= 1
            left = best
        else:
            gap, number, left = capacity, made, rest
            made += 1
        sequence[at], offset[at] = number, capacity - gap
        if left:
            open_[left] += 1
            members[left].append(number)
    return sequence, offset


def pack(cut_pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``cut_pieces`` with sequence_id and offset; needs a stored or otherwise cheap table."""
    shards = max(1, -(-cut_pieces.count() // shard_pieces))
    columns = cut_pieces.columns

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        sequence, offset = best_place(rows["_length"].to_numpy(), capacity)
        rows = rows.drop_columns(["_length"])
        rows = rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + sequence))
        return rows.append_column("offset", pa.array(offset))

    added = [StructField("_shard", IntegerType()), StructField("sequence_id", LongType()), StructField("offset", LongType())]
    schema = StructType([*cut_pieces.schema.fields, *added])
    dealt = cut_pieces.select(
        *columns,
        F.col(length).alias("_length"),
        F.pmod(F.xxhash64(*columns), F.lit(shards)).cast("int").alias("_shard"),
    )
    return dealt.groupBy("_shard").applyInArrow(packed, schema).drop("_shard")


def packed_documents(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    found = df.select(F.col(key), F.explode(pieces(text, path, capacity, end)).alias("_p")).select(key, "_p.*")
    return pack(stored(found, "pieces"), capacity=capacity)
