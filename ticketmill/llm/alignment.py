"""Two tokenizers' ids of the same text, aligned by the byte ends their tokens share.

The running byte ends of both id lists go into dictionaries from end to index; the
intersection of their keys, sorted, cuts both lists into groups, and the links of a group
are the pairs of its tokens whose bytes overlap. How often a pair of ids is linked in all
texts is counted over the whole table.

A plain character that is no white space, before a space or line feed, ends a token of both
tokenizers, and so does a Latin letter before an ASCII character that is none (checked for
the pieces when they are loaded; the byte-level tokenizer splits there by its expression).
These are shared ends: texts are cut there first, and each distinct part is aligned once per memo. The tokens of a long text are never held as rows.

Counts are summed map-side from arrays, then by Spark. The most frequent pairs, SHIPPED at
most, are sent to the tasks; rows that hold other pairs are joined with their counts by
pair, none of which is frequent.

Defined cases: a text that is null, empty, or not given back by the bytes of either list
has no tokens: zeros and an empty ``groups_sha256``; a tie for a B id's highest count makes
all tied pairs best; repeated rows and ids stay rows of their own and are counted each; an
empty table gives no rows; a long text is one row of two arrays, as long as the number of
different pairs in it; only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import stored, text_of
from .words import LETTER, PLAIN, Chunks, slices, split, strung, sums
from .words import SPACE as BLANK

SPACE = "▁"
CUTS = ((LETTER, BLANK), (PLAIN, BLANK), (LETTER, PLAIN))
BLANKS, OTHER_BLANKS = b" \n", b"\t\x0b\x0c\r"  # pieces join the others with what is before them
MEMO = 200_000  # parts whose alignment a worker keeps; it starts anew when full
MEMO_CHARS = 64  # longer parts are not kept
SHIPPED = 1 << 20  # pairs whose counts are sent to all tasks
HELD = 1 << 21  # counts a task sums before it passes them on

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Group(NamedTuple):
    """Indexes of a group's tokens: a[start_a:end_a] and b[start_b:end_b] hold the same bytes."""

    start_a: int
    end_a: int
    start_b: int
    end_b: int


def shared_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], dict[int, int], dict[int, int]]:
    """The byte ends both lists of running ends have, in order, and after how many tokens of each they come."""
    index_a, index_b = dict(zip(ends_a, count(1))), dict(zip(ends_b, count(1)))  # noqa: B905
    return sorted(index_a.keys() & index_b.keys()), index_a, index_b


def shared_groups(ends_a: list[int], ends_b: list[int]) -> list[Group]:
    """The finest groups whose bytes are the same, from the running ends of both lists."""
    shared, index_a, index_b = shared_ends(ends_a, ends_b)
    return [Group(index_a.get(p, 0), index_a[e], index_b.get(p, 0), index_b[e]) for p, e in zip([0, *shared], shared)]  # noqa: B905


def group_links(group: Group, ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int]]:
    """Pairs of indexes of the group's tokens whose byte ranges overlap."""
    a, b, found = group.start_a, group.start_b, []
    while a < group.end_a and b < group.end_b:
        found.append((a, b))
        a, b = a + (ends_a[a] <= ends_b[b]), b + (ends_b[b] <= ends_a[a])
    return found


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 as itself, others from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """A byte-level tokenizer (A) and a piece model (B) with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        vocabulary = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [
            bytes(alphabet[c] for c in vocabulary[i]) if set(vocabulary.get(i, "?ā́")) <= alphabet.keys() else b""
            for i in range(max(vocabulary) + 1)
        ]
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_b = [
            bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)
        ]
        odd = (self.b.is_byte, self.b.is_control, self.b.is_unknown)
        whole = [n.replace(SPACE, " ") for i, n in enumerate(names) if not any(is_odd(i) for is_odd in odd)]
        if (np.diff(split(pa.array(whole), BLANKS, CUTS, OTHER_BLANKS).bounds) > 1).any():
            raise ValueError(f"{path_b}: a piece goes on after a character and white space")
        if self.b.encode(_LEAD, out_type=str) != [SPACE, "<0x0A>"]:
            raise ValueError(f"{path_b}: only models that put a space in front and write line feeds as bytes are supported")
        self.size_b = size
        self.size_a, self.sizes_b = [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        self.names_a, self.names_b = [str(i) for i in range(len(self.bytes_a))], [str(i) for i in range(size)]
        # One integer a pair of ids.
        self.code = "I" if len(self.bytes_a) * size <= 1 << 32 else "Q"
        self.memo: dict[str, tuple] = {}

    def ids(self, parts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """A's and B's ids of texts that already have their leading space."""
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            # The model's own space goes before a line feed, which joins nothing; both are taken off again.
            ids_b = self.b.encode([_LEAD + x for x in some], num_threads=1)
            for coded, ids in zip(self.a.encode_batch_fast(some, add_special_tokens=False), ids_b, strict=True):
                yield coded.ids, ids[2:]

    def same_bytes(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        data = text.encode()
        return b"".join([self.bytes_a[i] for i in ids_a]) == data and b"".join([self.bytes_b[i] for i in ids_b]) == data

    def groups(self, ids_a: list[int], ids_b: list[int]) -> list[Group]:
        ends = (list(accumulate([sizes[i] for i in ids])) for sizes, ids in ((self.size_a, ids_a), (self.sizes_b, ids_b)))
        return shared_groups(*ends)

    def _aligned(self, part: str, ids_a: list[int], ids_b: list[int]) -> tuple:
        """Of a part: the numbers of its tokens, groups and links, whether its bytes differ, its groups written out, its pairs."""
        if not self.same_bytes(part, ids_a, ids_b):
            return _BROKEN
        ends_a, ends_b = list(accumulate([self.size_a[i] for i in ids_a])), list(accumulate([self.sizes_b[i] for i in ids_b]))
        shared, index_a, index_b = shared_ends(ends_a, ends_b)
        names_a, names_b, size_b = self.names_a, self.names_b, self.size_b
        written, pairs, a, b = [], [], 0, 0
        for end in shared:
            next_a, next_b = index_a[end], index_b[end]
            if next_a - a == 1 == next_b - b:
                x, y = ids_a[a], ids_b[b]
                written.append(f"{names_a[x]}|{names_b[y]};")
                pairs.append(x * size_b + y)
            else:
                some_a, some_b = ids_a[a:next_a], ids_b[b:next_b]
                written.append(f"{','.join([names_a[x] for x in some_a])}|{','.join([names_b[y] for y in some_b])};")
                if len(some_a) == 1 or len(some_b) == 1:
                    pairs += [x * size_b + y for x in some_a for y in some_b]
                else:
                    pairs += [ids_a[i] * size_b + ids_b[j] for i, j in group_links(Group(a, next_a, b, next_b), ends_a, ends_b)]
            a, b = next_a, next_b
        return len(ids_a), len(ids_b), len(shared), len(pairs), 0, "".join(written).encode(), array(self.code, pairs).tobytes()

    def lookup(self, texts: pa.Array) -> tuple[Chunks, list[tuple]]:
        """The parts of the texts, and what is known of each distinct one."""
        memo = self.memo
        if len(memo) >= MEMO:
            memo.clear()
        chunks = split(pa.array([" " + t if t else t for t in texts.to_pylist()], pa.string()), BLANKS, CUTS, OTHER_BLANKS)
        parts = chunks.values.to_pylist()
        found = list(map(memo.get, parts))
        new = [i for i, x in enumerate(found) if x is None]
        for i, (ids_a, ids_b) in zip(new, self.ids([parts[i] for i in new]), strict=True):
            found[i] = known = self._aligned(parts[i], ids_a, ids_b)
            if len(parts[i]) <= MEMO_CHARS:
                memo[parts[i]] = known
        return chunks, found

    def rows(self, texts: pa.Array) -> Iterator[tuple]:
        """Of each text: the counts, the hash of its groups, its different pairs and how often it has each."""
        chunks, known = self.lookup(texts)
        numbers = np.array([k[:5] for k in known], np.int64).reshape(-1, 5)
        *counts, broken = (sums(numbers[:, c], chunks).tolist() for c in range(5))
        groups, pairs = strung([k[5] for k in known], chunks), strung([k[6] for k in known], chunks)
        for row, (written, packed) in enumerate(zip(groups, pairs, strict=True)):
            if broken[row] or not counts[0][row]:
                yield 0, 0, 0, 0, "", b"", b""
                continue
            codes = np.sort(np.frombuffer(packed, self.code))
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            times = np.diff(first, append=len(codes)).astype(np.uint32)
            yield *(c[row] for c in counts), hashlib.sha256(written[:-1]).hexdigest(), codes[first].tobytes(), times.tobytes()


_LEAD = "\n"
_BROKEN = (0, 0, 0, 0, 1, b"", b"")


@lru_cache(4)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_FOUND = (*((n, pa.int64()) for n in _COUNTS), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary()))


def aligned(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links and groups_sha256, and the row's pairs: ``codes`` (A id times the size of
    B's vocabulary plus B id, unsigned integers of 32 bits, or of 64 for large vocabularies) and ``times`` (of 32 bits)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = aligner(path_a, path_b)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                rows = list(tables.rows(texts))
                columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_FOUND)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(rows)), *columns], names=["key", *(n for n, _ in _FOUND)])
                at += len(rows)

    rows = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(found, f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary")


def groups(text: Column | str, path_a: str, path_b: str) -> Column:
    """The groups of a text themselves: array<struct<a: array<int>, b: array<int>>>."""

    @F.arrow_udf("array<struct<a: array<int>, b: array<int>>>")
    def listed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = aligner(path_a, path_b)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            found = []
            for text in batch.to_pylist():
                ((ids_a, ids_b),) = tables.ids([" " + text]) if text else [([], [])]
                some = tables.groups(ids_a, ids_b) if text and tables.same_bytes(" " + text, ids_a, ids_b) else []
                found.append([{"a": ids_a[g.start_a : g.end_a], "b": ids_b[g.start_b : g.end_b]} for g in some])
            yield pa.array(found, kind)

    return listed(text_of(text))


def _unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The integers of all rows, and where each row's begin and end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    bounds = (offsets - offsets[0]) // np.dtype(kind).itemsize
    return np.frombuffer(data, kind).astype(np.int64), bounds


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(times, first) if len(first) else times


def pair_counts(found: DataFrame, size_b: int, code: str = "I") -> DataFrame:
    """(code, n, best) of all pairs in the columns ``codes`` and ``times``; best: no pair of the B id has a higher count."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append((_unpacked(batch.column(0), code)[0], _unpacked(batch.column(1), "I")[0]))
            count += len(held[-1][0])
            if count < HELD:
                continue
            codes, times = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, count = [(codes, times)], len(codes)
            if count > HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times)], names=["code", "n"])
                held, count = [], 0
        if held:
            codes, times = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times)], names=["code", "n"])

    counts = found.select("codes", "times").mapInArrow(partial, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("b", F.expr(f"int(code % {size_b}L)")), "pair-counts")
    # One row an id of B: its vocabulary bounds what is sent to the tasks.
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), "b").select("code", "n", (F.col("n") == F.col("highest")).alias("best"))


def _frequent(counts: DataFrame, shipped: int) -> int:
    """The least power of two that ``shipped`` pairs at most reach with their counts."""
    sizes = counts.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()  # 63 rows at most
    total, least = 0, 64
    for bits, pairs in sorted(map(tuple, sizes), reverse=True):
        total += pairs
        if total > shipped:
            break
        least = bits
    return 1 << min(least - 1, 62)


def alignments(
    df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", shipped: int = SHIPPED
) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark = df.sparkSession
    found = aligned(df, path_a, path_b, key, text)
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "alignments")
    code = aligner(path_a, path_b).code
    counts = stored(pair_counts(found, aligner(path_a, path_b).size_b, code), "pairs")
    least = _frequent(counts, shipped)
    sent = counts.filter(F.col("n") >= least).toArrow().sort_by("code")
    known = spark.sparkContext.broadcast(tuple(sent[c].to_numpy() for c in ("code", "n", "best")))

    @F.arrow_udf("n_best long, count_sum long, rest array<struct<code: long, times: long>>")
    def valued(codes: pa.Array, times: pa.Array) -> pa.Array:
        known_codes, known_n, known_best = known.value
        (all_codes, bounds), all_times = _unpacked(codes, code), _unpacked(times, "I")[0]
        at = np.minimum(np.searchsorted(known_codes, all_codes), max(len(known_codes) - 1, 0))
        there = known_codes[at] == all_codes if len(known_codes) else np.zeros(len(all_codes), bool)
        n = np.where(there, known_n[at], 0) if len(known_codes) else np.zeros(len(all_codes), np.int64)
        best = there & known_best[at] if len(known_codes) else there

        def per_row(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[bounds[1:]] - total[bounds[:-1]]

        rest = pa.StructArray.from_arrays([pa.array(all_codes[~there]), pa.array(all_times[~there])], names=["code", "times"])
        offsets = np.concatenate([[0], np.cumsum(per_row(~there))]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(per_row(all_times * best)), pa.array(per_row(all_times * n)), pa.ListArray.from_arrays(offsets, rest)],
            names=["n_best", "count_sum", "rest"],
        )

    rows = found.select("row", "key", *_COUNTS, "groups_sha256", valued("codes", "times").alias("v"))
    rows = stored(rows.select("row", "key", *_COUNTS, "groups_sha256", "v.*"), "valued")
    result = [F.col("key").alias(key), *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    rare = rows.filter(F.size("rest") > 0)
    apart = rare.select("row", F.explode("rest").alias("x")).select("row", "x.*")
    added = (
        apart.join(counts.filter(F.col("n") < least), "code")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("b"), F.sum(F.col("times") * F.col("n")).alias("s"))
    )
    joined = rare.join(added, "row").withColumns({"n_best": F.col("n_best") + F.col("b"), "count_sum": F.col("count_sum") + F.col("s")})
    return rows.filter(F.size("rest") == 0).select(*result).unionByName(joined.select(*result))
