"""Greedy longest-match token counts by a trie with failure links.

Each trie node stores where to go on when no child matches, and how many pieces
greedy matching has then finished ("popped"). A word is read once, character by
character; its token count is the sum of the popped counts on the way. No piece is
ever built.

A vocabulary has pieces that start a word and pieces that go on. A word is a run
of characters other than ASCII white space; one that greedy matching cannot spell
counts as a single unknown token.

Defined cases: null and blank texts have no words; any other columns pass unchanged.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .words import ASCII_SPACES, LETTER, PLAIN, REST, SPACE, slices, split, sums

MEMO = 400_000  # words whose count a worker keeps; it starts anew when full
MEMO_CHARS = 64
CUTS = ((LETTER, SPACE), (PLAIN, SPACE), (REST, SPACE))

_START, _GO_ON, _DEAD = 0, 1, -1


class Counter(dict):
    """Word to number of tokens, -1 for unknown; as a dictionary it is the memo."""

    def __init__(self, starting: Iterable[str], going_on: Iterable[str]):
        self.child: dict[tuple[int, str], int] = {}
        parent, letter, ends = [_DEAD, _DEAD], ["", ""], [False, False]
        for root, pieces in ((_START, starting), (_GO_ON, going_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.child.get((node, c))
                    if nxt is None:
                        nxt = self.child[node, c] = len(parent)
                        parent.append(node)
                        letter.append(c)
                        ends.append(False)
                    node = nxt
                ends[node] = node > _GO_ON
        self.fail, self.popped = [_DEAD] * len(parent), [0] * len(parent)
        below: dict[int, list[int]] = {}
        for node in range(2, len(parent)):
            below.setdefault(parent[node], []).append(node)
        queue = deque(below.get(_START, []) + below.get(_GO_ON, []))
        while queue:
            node = queue.popleft()
            queue.extend(below.get(node, ()))
            if ends[node]:
                self.fail[node], self.popped[node] = _GO_ON, 1
                continue
            at, popped = self.fail[parent[node]], self.popped[parent[node]]
            while at != _DEAD and (at, letter[node]) not in self.child:
                popped += self.popped[at]
                at = self.fail[at]
            if at != _DEAD:
                self.fail[node], self.popped[node] = self.child[at, letter[node]], popped

    def count(self, word: str) -> int:
        child, fail, popped = self.child, self.fail, self.popped
        at, total = _START, 0
        for c in word:
            nxt = child.get((at, c))
            while nxt is None:
                total += popped[at]
                at = fail[at]
                if at == _DEAD:
                    return -1
                nxt = child.get((at, c))
            at = nxt
        while at > _GO_ON:
            total += popped[at]
            at = fail[at]
        return total if at != _DEAD else -1

    def __missing__(self, word: str) -> int:
        count = self.count(word)
        if len(word) <= MEMO_CHARS:
            self[word] = count
        return count

    def counts(self, texts: pa.Array) -> list[np.ndarray]:
        """Per text: words, tokens, unknown words."""
        if len(self) >= MEMO:
            self.clear()
        chunks = split(texts, ASCII_SPACES, CUTS)
        words = [c.strip(ASCII_SPACES) for c in chunks.values.cast(pa.binary()).to_pylist()]
        found = np.array([self[w.decode()] if w else 0 for w in words], np.int64)
        is_word = np.array([bool(w) for w in words], np.int64)
        return [sums(v.astype(np.int64), chunks) for v in (is_word, np.where(found < 0, 1, found), found < 0)]


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece model: those with a leading U+2581 start a word."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return [n[1:] for n in names if n[0] == "▁" and n[1:]], [n for n in names if n[0] != "▁"]


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(*vocabulary(path))


def token_counts(text: Column | str, path: str) -> Column:
    """n_words, n_tokens and n_unknown of a text."""

    @F.arrow_udf("n_words long, n_tokens long, n_unknown long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = counter(path)
        for batch in batches:
            found = [words.counts(texts) for texts in slices(batch)]
            columns = [np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(3)]
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["n_words", "n_tokens", "n_unknown"])

    return count(text_of(text))


def document_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    return df.select(F.col(key), token_counts(text, path).alias("_c")).select(key, "_c.*")
