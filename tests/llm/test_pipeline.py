"""The pipeline against the plain composition of brute-force stages."""

import hashlib
import os
import re
import sys

import numpy as np
from test_fingerprints_and_joins import _groups
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from ticketmill.llm import language, pii, tagger  # noqa: E402
from ticketmill.llm.common import stored  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows(docs):
    return {r.doc_id: r for r in docs.collect()}


def test_stages(spark, folder, word_model):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = _rows(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, folder), "test")
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        got = _rows(out)
        if name == "language id":
            wanted = {r.doc_id for r in language.identified(docs).collect() if not r.rejected}
            assert set(got) == wanted and len(wanted) >= 0.99 * len(kept)
        elif name == "exact dedup":
            first = {}
            for i in sorted(kept):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i].text), i)
            assert set(got) == set(first.values())
        elif name == "n-gram jaccard join":
            groups = _groups([(i, r.text) for i, r in kept.items()], corpus_pipeline.NEAR)
            assert set(got) == {i for i, _, least in groups if i == least}
        else:
            for i, r in kept.items():
                text = pii.mask(r.text, pii.spans_of([r.text], tagger.trained())[0])
                assert got[i].text == text and got[i].n_chars == len(text)
                assert not pii.base_spans(got[i].text)
        docs, kept = out, got
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    library = Tokenizer.from_file(word_model)
    lengths = {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in kept.items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths
    run = corpus_pipeline.run(spark, folder).collect()
    digest = lambda rows: hashlib.sha256(repr(sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)).encode()).hexdigest()
    assert digest(run) == digest(packed)


def test_odd_rows(spark, folder, odd_rows):
    rows = [(i, t, "en" if n % 3 else None, None, len(t or "")) for n, (i, t) in enumerate(odd_rows)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "test")
    assert docs.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_near_copies_of_repeated_ids(spark, folder):
    words = [f"word{i}" for i in range(60)]
    near = [" ".join([*words, f"end{i}"]) for i in range(6)]
    alone = [" ".join(f"{c}{i}" for i in range(40)) for c in "xyz"]
    texts = [(7, near[0]), (7, near[1]), (7, alone[0]), (9, near[2]), (9, alone[1]), (None, near[3]), (None, alone[2]), (-5, None), (-5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], SCHEMA)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.without_near_copies(spark, docs, folder).collect()]
    assert sum(t in near for _, t in got) == 1 and all(i == 7 for i, t in got if t in near)
    rest = [r for r in texts if r[1] not in near]
    assert sorted(map(repr, (r for r in got if r[1] not in near))) == sorted(map(repr, rest))
    negative = spark.createDataFrame([(i, near[n], "en", "s", 9) for n, i in enumerate((3, -2, 0, -1))], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.without_near_copies(spark, negative, folder).collect()] == [-2]


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert np.all([n in names for n in __spark_entry__.oracle_sql()])
