"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

The encoding of a text ends, for each of its prefixes, in one last piece. An
automaton finds the pieces that end at a position; of these, the last piece of the
prefix is the only one that is compatible with the last piece of the prefix before
it, that is, whose joint encoding is just the two. The ids follow backwards from
the end of the text. Work is linear in the text, with no queue of merges.

The model's normaliser must be the plain one (spaces become U+2581, one is put in
front); Latin letters must share pieces with nothing but a U+2581 before them. Both are
checked when a model is loaded. Runs of U+2581, whose pieces all have one score,
are merged by position instead.

Defined cases: null is an empty text; an empty text has no ids; characters without
a piece become their UTF-8 bytes; any other columns pass unchanged.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .words import LETTER as PLAIN_LETTER
from .words import PLAIN, REST, Chunks, slices, strung, sums
from .words import SPACE as BLANK
from .words import split

SPACE = "▁"
MEMO = 400_000  # chunks whose encoding a worker keeps; it starts anew when full
MEMO_CHARS = 64  # longer chunks are not kept
# Latin letters; pieces of a supported model join them with no other character but U+2581.
LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u1e00-\u1eff"
LETTER = re.compile(f"[{LATIN}]")
CUTS = ((PLAIN_LETTER, PLAIN), (PLAIN, PLAIN_LETTER), (PLAIN_LETTER, BLANK), (PLAIN, BLANK), (REST, BLANK))
CHUNK = re.compile(f"{SPACE}*[{LATIN}]+|{SPACE}*[^{SPACE}{LATIN}]+|{SPACE}+")


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("byte-by-byte", _one_by_one)


class Encoder:
    """One model's tables."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "  Abé  \n\t ﬁ 1́ "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError(f"{path}: only models with the plain normaliser are supported")
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        ids = {n: i for i, n in enumerate(names) if not (special[i] or model.is_byte(i) or model.is_unused(i))}
        for name in ids:
            body = name.lstrip(SPACE)
            if SPACE in body or (any(map(LETTER.match, body)) and not all(map(LETTER.match, body))):
                raise ValueError(f"{path}: piece {name!r} joins Latin letters with others")
        self.surface = [
            bytes([int(n[3:5], 16)])
            if model.is_byte(i)
            else b""
            if model.is_control(i)
            else " ⁇ ".encode()
            if special[i]
            else n.replace(SPACE, " ").encode()
            for i, n in enumerate(names)
        ]
        self.is_space = [n.startswith(SPACE) for n in names]
        self.runs = {len(n): i for n, i in ids.items() if not n.strip(SPACE)}
        ordered = sorted((n for n in ids if len(n) > 1 and n.strip(SPACE)), key=lambda n: -model.get_score(ids[n]))
        if len({model.get_score(ids[n]) for n in ordered}) < len(ordered):
            raise ValueError(f"{path}: two pieces have one score")
        chars = {c for n in ordered for c in n} | {n for n in ids if len(n) == 1}
        if not all(c in ids for c in chars):
            raise ValueError(f"{path}: a character of a piece is no piece")
        self._check_cuts(ids)
        self.unknown = re.compile("[^" + re.escape("".join(sorted(chars))) + "]")
        self.ids, self.size = ids, {ids[n]: len(n) for n in ids}
        self.rank = {ids[c]: -1 for c in chars}
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for c in chars:
            self.automaton.add_word(c, (ids[c], 1))
        by_rank = {n: r for r, n in enumerate(ordered)}
        for rank, name in enumerate(ordered):
            parts = self._merge(name, by_rank, rank)
            if len(parts) == 2:  # else the merges of better pieces never lead to it
                self.halves[ids[name]] = (ids[parts[0]], ids[parts[1]])
                self.rank[ids[name]] = rank
                self.automaton.add_word(name, (ids[name], len(name)))
        for name, rank in by_rank.items():
            for cut in range(1, len(name)):
                a, b = ids.get(name[:cut]), ids.get(name[cut:])
                if a in self.rank and b in self.rank:
                    self.pairs[a, b] = rank
        self.automaton.make_automaton()
        self.compatible = lru_cache(400_000)(self._compatible)
        self.memo = _Memo(self)

    @staticmethod
    def _check_cuts(names: Iterable[str]) -> None:
        """No piece may cross a place where ``split`` cuts."""
        listed = [n for n in names if n.strip(SPACE)]
        found = np.diff(split(pa.array([n.replace(SPACE, " ") for n in listed]), b" ", CUTS).bounds)
        if (found > 1).any():
            raise ValueError(f"piece {listed[int(np.argmax(found > 1))]!r} would be cut")

    @staticmethod
    def _merge(name: str, by_rank: dict[str, int], below: int) -> list[str]:
        """``name`` after all merges that rank before ``below``; for building the tables only."""
        parts = list(name)
        while len(parts) > 2:
            best, at = min((by_rank.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, a: int, b: int) -> bool:
        """Whether encoding the joined text of the two pieces gives just them.

        Takes merges back, the latest first, and looks whether one across the
        border would have come before the merge taken back.
        """
        limit = len(self.rank) + 1
        while True:
            if self.pairs.get((a, b), limit) < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.halves[a][1]
            elif self.rank[b] < 0:
                return True
            else:  # of equal merges the left one comes first
                limit, b = self.rank[b] + 1, self.halves[b][0]

    def _known(self, text: str) -> list[int]:
        last = [-1] * len(text)
        for end, (piece, size) in self.automaton.iter(text):
            if last[end] < 0:
                before = end - size
                if before < 0 or self.compatible(last[before], piece):
                    last[end] = piece
        found, at = [], len(text) - 1
        while at >= 0:
            found.append(last[at])
            at -= self.size[last[at]]
        return found[::-1]

    def _body(self, text: str) -> list[int]:
        if not self.unknown.search(text):
            return self._known(text) if text else []
        found, at = [], 0
        for m in self.unknown.finditer(text):
            if m.start() > at:
                found += self._known(text[at : m.start()])
            found += [self.bytes[b] for b in m.group().encode()]
            at = m.end()
        return found + self._known(text[at:]) if at < len(text) else found

    @lru_cache(256)  # noqa: B019
    def _run(self, count: int) -> tuple[int, ...]:
        """``count`` U+2581: all merges have one score, so the leftmost comes first."""
        size, after, before = [1] * count, list(range(1, count + 1)), list(range(-1, count - 1))
        queue = [i for i in range(count - 1) if 2 in self.runs]
        heapq.heapify(queue)
        while queue:
            at = heapq.heappop(queue)
            right = after[at]
            if not size[at] or right >= count or size[at] + size[right] not in self.runs:
                continue
            size[at] += size[right]
            size[right], after[at] = 0, after[right]
            if after[at] < count:
                before[after[at]] = at
                heapq.heappush(queue, at)
            if before[at] >= 0:
                heapq.heappush(queue, before[at])
        return tuple(self.runs[s] for s in size if s)

    def chunk(self, text: str) -> list[int]:
        """Ids of a run of U+2581 and the letters, or the other characters, after it."""
        body = text.lstrip(SPACE)
        spaces = len(text) - len(body)
        if not body or not spaces:
            return [*self._run(spaces), *self._body(body)]
        found = self._body(SPACE + body)
        alone = found[0] == self.ids[SPACE]
        return [*self._run(spaces - 1 + alone), *found[alone:]]

    def encode(self, text: str) -> list[int]:
        return [i for c in CHUNK.findall(SPACE + text.replace(" ", SPACE)) for i in self.chunk(c)] if text else []

    def lookup(self, texts: pa.Array) -> tuple[Chunks, list[tuple[int, bytes, bytes]]]:
        """Chunks of the texts and, of each distinct one, what ``_Memo`` holds."""
        if len(self.memo) >= MEMO:
            self.memo.clear()
        led = pa.array([" " + t.replace(SPACE, " ") if t else t for t in texts.to_pylist()], pa.string())
        chunks = split(led, b" ", CUTS)
        return chunks, [self.memo[c] for c in chunks.values.to_pylist()]

    def decode(self, ids: list[int]) -> str:
        first = next((i for i in ids if self.surface[i]), None)
        data = b"".join([self.surface[i] for i in ids])
        return self._text(data, first is not None and self.is_space[first])

    @staticmethod
    def _text(data: bytes, led: bool) -> str:
        return data[1 if led else 0 :].decode("utf-8", "byte-by-byte")

    def digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, SHA-256 of the ids, SHA-256 of the text decoded from them."""
        chunks, known = self.lookup(texts)
        counts = sums(np.array([k[0] for k in known], np.int64), chunks)
        ids, surfaces = strung([k[1] for k in known], chunks), strung([k[2] for k in known], chunks)
        for count, listed, decoded in zip(counts.tolist(), ids, surfaces, strict=True):
            yield count, hashlib.sha256(listed[:-1]).hexdigest(), hashlib.sha256(decoded[1:]).hexdigest()


class _Memo(dict):
    """Of a chunk: number of ids, the ids with a comma after each, the text decoded from them."""

    def __init__(self, tables: Encoder):
        self.tables = tables

    def __missing__(self, chunk: str) -> tuple[int, bytes, bytes]:
        ids = [i for c in CHUNK.findall(chunk.replace(" ", SPACE)) for i in self.tables.chunk(c)]
        text = b"".join([self.tables.surface[i] for i in ids]).decode("utf-8", "byte-by-byte").encode()
        part = len(ids), "".join([f"{i}," for i in ids]).encode(), text
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = part
        return part


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(text: Column | str, path: str) -> Column:
    """The ids of a text: array<int>."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = encoder(path)
        for batch in batches:
            yield pa.array([tables.encode(t.as_py()) for t in batch], pa.list_(pa.int32()))

    return ids(text_of(text))


def decode(ids: Column | str, path: str) -> Column:
    """The text of ids; null for null."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = encoder(path)
        for batch in batches:
            yield pa.array([None if i.as_py() is None else tables.decode(i.as_py()) for i in batch], pa.string())

    return text(F.col(ids) if isinstance(ids, str) else ids)


def digests(text: Column | str, path: str) -> Column:
    """n_tokens, ids_sha256 and decoded_sha256 of a text: what encode and decode give, in a few bytes."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = encoder(path)
        for batch in batches:
            rows = [row for texts in slices(batch) for row in tables.digests(texts)]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(text_of(text))


def encoded_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    return df.select(F.col(key), digests(text, path).alias("_d")).select(key, "_d.*")
