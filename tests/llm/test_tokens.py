"""Tokenising operators against the libraries and against plain greedy matching."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticketmill.llm import packing, pieces, wordpiece, words

ALPHABET = [
    "a", "B", " ", "  ", "\n", "\t", "é", "É", "é", "H̱", "1", "2", "'s", "don't", "(", ")", "the", "Ing",
    "İ", "Σ", "ΑΣ", "日本", "🎉", "<|endoftext|>", "<|EndOfText|>", "<s>", "<0x0A>", "=", "̸", "ß", "×", "÷", "'",
    "\x1c", "\x85", "\xa0", "¿", "▁", "\x00", "\x01", "return", "   ",
]


def _texts(seed, count=4000, longest=25):
    rng = random.Random(seed)
    found = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(count)]
    return found + ["", " ", "a" * 3000, "ab" * 2000, "́" * 40, *[" " * k + "a" for k in range(40)], *[" " * k for k in range(40)]]


def test_pieces_equal_the_library(piece_model):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    ours = pieces.encoder(piece_model)
    texts = _texts(1)
    digests = list(ours.digests(pa.array(texts)))
    for text, (count, ids, decoded) in zip(texts, digests, strict=True):
        want = library.encode(text)
        assert ours.encode(text) == want, text
        assert ours.decode(want) == library.decode(want)
        assert count == len(want) and ids == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert decoded == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_any_ids_decode_as_in_the_library(piece_model):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    rng, ours = random.Random(2), pieces.encoder(piece_model)
    for _ in range(3000):
        ids = [rng.randrange(1, 400) if rng.random() < 0.5 else rng.randrange(32000) for _ in range(rng.randint(0, 8))]
        assert ours.decode(ids) == library.decode(ids)


def test_piece_columns(spark, piece_model, odd_rows):
    df = spark.createDataFrame([(*r, 1) for r in odd_rows], "doc_id long, text string, n_tokens int")
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    rows = df.withColumn("ids", pieces.encode("text", piece_model)).withColumn("back", pieces.decode("ids", piece_model)).collect()
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.back == library.decode(r.ids)
    digests = pieces.encoded_digests(df, piece_model).collect()
    assert sorted(r.n_tokens for r in digests) == sorted(len(r.ids) for r in rows)
    assert pieces.encoded_digests(df.limit(0), piece_model).count() == 0


def test_word_ids_equal_the_library(word_model):
    library = Tokenizer.from_file(word_model)
    texts = _texts(3)
    for text, got in zip(texts, packing.encoder(word_model).encode(pa.array(texts)), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def _greedy(word, starting, going_on):
    at = count = 0
    while at < len(word):
        known = going_on if at else starting
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return -1
        at, count = end, count + 1
    return count


def test_word_piece_counts_are_greedy():
    rng = random.Random(4)
    for _ in range(40):
        make = lambda n: {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(n)}
        starting, going_on = make(6), make(6)
        counter = wordpiece.Counter(starting, going_on)
        for _ in range(200):
            word = "".join(rng.choice("abc" if rng.random() < 0.1 else "ab") for _ in range(rng.randint(1, 12)))
            assert counter.count(word) == _greedy(word, starting, going_on), (word, starting, going_on)


def test_word_piece_columns(spark, piece_model, odd_rows):
    starting, going_on = map(set, wordpiece.vocabulary(piece_model))
    df = spark.createDataFrame(odd_rows, "doc_id long, text string")
    got = df.select("text", wordpiece.token_counts("text", piece_model).alias("c")).select("text", "c.*").collect()
    for r in got:
        counts = [_greedy(w.decode(), starting, going_on) for w in (r.text or "").encode().split()]
        assert (r.n_words, r.n_unknown) == (len(counts), counts.count(-1))
        assert r.n_tokens == sum(1 if c < 0 else c for c in counts)


def test_chunks_join_to_the_texts():
    texts = _texts(5, 300)
    cuts = ((words.LETTER, words.PLAIN), (words.PLAIN, words.SPACE), (words.LETTER, words.SPACE))
    chunks = words.split(pa.array(texts), b" ", cuts)
    values = chunks.values.to_pylist()
    for text, a, b in zip(texts, chunks.bounds[:-1], chunks.bounds[1:], strict=True):
        assert "".join(values[c] for c in chunks.codes[a:b]) == text
    assert [len(s) for s in words.slices(pa.array(["x"] * 5))] == [5]


@pytest.mark.parametrize("which", [0, 1])
def test_placing_is_the_rule(which):
    """Each piece goes where the sum of squares becomes smallest."""
    rng = random.Random(6)
    lengths = np.array([rng.randint(1, 20) for _ in range(300)])
    order = packing.orders(lengths, 20)[which]
    sequence, offset = packing.place(lengths, 20, order)
    gaps, counts, at = {}, [0] * 21, {}
    for i in order.tolist():
        size = int(lengths[i])

        def total(gap, left, counts=counts):
            new = list(counts)
            if gap < 20:
                new[gap] -= 1
            if left:
                new[left] += 1
            return sum(c * c for c in new)

        options = [total(g, g - size) for g in range(size, 20) if counts[g]] + [total(20, 20 - size)]
        gap = gaps.get(sequence[i], 20)
        assert total(gap, gap - size) == min(options) and gap >= size
        assert offset[i] == at.get(sequence[i], 0) == 20 - gap
        if gap < 20:
            counts[gap] -= 1
        if gap > size:
            counts[gap - size] += 1
        gaps[sequence[i]], at[sequence[i]] = gap - size, offset[i] + size


def test_few_sequences():
    """Nearly as few as the tokens need."""
    rng = np.random.default_rng(9)
    lengths = np.minimum(np.maximum(rng.lognormal(6, 1.2, 20_000).astype(int), 1), 4096)
    sequence, _ = packing.best_place(lengths, 4096)
    assert len(set(sequence.tolist())) <= 1.001 * lengths.sum() / 4096 + 1


@pytest.mark.parametrize("shard", [200_000, 40])
def test_packing(spark, word_model, odd_rows, shard):
    rng = random.Random(7)
    rows = odd_rows + [(100 + i, "word " * rng.randint(0, 3000)) for i in range(80)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, offset string")
    cut = df.select("doc_id", F.explode(packing.pieces("text", word_model, with_ids=True)).alias("p")).select("doc_id", "p.*")
    got = packing.pack(cut, shard_pieces=shard).collect()
    library = Tokenizer.from_file(word_model)
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    key = lambda r: repr(r[:5])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=key) == sorted(want, key=key)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    if shard > len(got):
        assert len(places) <= -(-sum(r.length for r in got) // 4096) + 2


def test_packing_empty(spark, word_model):
    assert packing.packed_documents(spark.createDataFrame([], "doc_id long, text string"), word_model).count() == 0
