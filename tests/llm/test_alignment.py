"""Alignments against a character-by-character brute force over whole texts."""

import hashlib
from collections import Counter
from functools import cache

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ticketmill.llm import alignment
from ticketmill.llm.common import table

ODD = [
    None, "", "a ▁ b", "\n\n x\t\ty     z  ", "<|endoftext|> <s> <0x41> don't  I'll", "日本 🎉 １２ \u3000 x\u0085 y \x1c z\x00 é",
    "   ", "it's a'b c1d", "x" * 3000, "\n", " lead", "end\r\n  two;\r\n\tthree", "word, word, word",
]


PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))


@cache
def _plain_model(path):
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _encoded(tables, text):
    """Ids and bytes of the whole text, without cutting it first."""
    if not text:
        return [], [], [], []
    a, b = tables.a.encode(" " + text, add_special_tokens=False).ids, _plain_model(PIECES).encode(text)
    bytes_a, bytes_b = [tables.bytes_a[i] for i in a], [tables.bytes_b[i] for i in b]
    whole = (" " + text).encode()
    return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == whole else ([], [], [], [])


def _brute(tables, texts):
    rows, linked = [], []
    for text in texts:
        a, b, bytes_a, bytes_b = _encoded(tables, text)
        owner_a = [i for i, p in enumerate(bytes_a) for _ in p]
        owner_b = [i for i, p in enumerate(bytes_b) for _ in p]
        last_a = {i: at for at, i in enumerate(owner_a)}
        last_b = {i: at for at, i in enumerate(owner_b)}
        written, at = [], 0
        for end in sorted(set(last_a.values()) & set(last_b.values())):
            some = [[str(ids[i]) for i in sorted(set(owner[at : end + 1]))] for ids, owner in ((a, owner_a), (b, owner_b))]
            written.append("|".join(",".join(ids) for ids in some))
            at = end + 1
        pairs = [(a[i], b[j]) for i, j in sorted(set(zip(owner_a, owner_b, strict=True)))]
        digest = hashlib.sha256(";".join(written).encode()).hexdigest() if a else ""
        rows.append((len(a), len(b), len(written), len(pairs), digest))
        linked.append(pairs)
    counts = Counter(p for pairs in linked for p in pairs)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    best = [sum(counts[p] == highest[p[1]] for p in pairs) for pairs in linked]
    return [(*r[:4], n, sum(counts[p] for p in pairs), r[4]) for r, n, pairs in zip(rows, best, linked, strict=True)]


@pytest.mark.parametrize("shipped", [alignment.SHIPPED, 300, 0])
def test_rows_equal_brute_force(spark, folder, byte_model, piece_model, shipped):
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").limit(40).collect()]
    rows += [(-1 - i, text) for i, text in enumerate(ODD)] + [(None, "no id"), (-1, None), (-13, "word, word, word")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "codes": F.lit(2), "b": F.lit(3)})
    want = _brute(alignment.aligner(byte_model, piece_model), [text for _, text in rows])
    got = alignment.alignments(df, byte_model, piece_model, shipped=shipped)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter((r[0], *w) for r, w in zip(rows, want, strict=True))


def test_groups_hold_the_same_bytes(spark, byte_model, piece_model):
    tables = alignment.aligner(byte_model, piece_model)
    df = spark.createDataFrame([(t,) for t in ODD], "text string")
    for text, groups in df.select("text", alignment.groups("text", byte_model, piece_model)).collect():
        sides = [[(b"".join(tables.bytes_a[i] for i in g.a), b"".join(tables.bytes_b[i] for i in g.b)) for g in groups]][0]
        assert all(a == b for a, b in sides)
        assert b"".join(a for a, _ in sides) == (b"" if not text or "▁" in text else (" " + text).encode())


def test_links_of_a_group_overlap():
    ends_a, ends_b = [2, 5, 9], [3, 4, 9]
    assert alignment.shared_groups(ends_a, ends_b) == [(0, 3, 0, 3)]
    assert alignment.group_links(alignment.Group(0, 3, 0, 3), ends_a, ends_b) == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 2)]


def test_no_rows(spark, byte_model, piece_model):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignments(empty, byte_model, piece_model).collect() == []
