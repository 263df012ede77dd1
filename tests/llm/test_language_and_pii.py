"""Language by held-out accuracy, personal data by brute force and held-out recall."""

import math
import random
import re
import time
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.llm import language, pii, tagger
from ticketmill.llm.common import table


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = language.identified(docs).withColumn("held_out", language.held_out())
    held = found.filter("held_out")
    right = held.filter("lang = lang_pred").count()
    assert right >= 0.97 * held.count() > 0
    assert found.count() == docs.count() and found.filter("score < 0 OR score > 1").count() == 0
    assert found.filter("rejected").count() <= 0.01 * found.count()


def test_odd_rows_of_language(spark, odd_rows):
    rows = [(*r, "en" if i % 2 else None, "x") for i, r in enumerate(odd_rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language.identified(df).collect()
    assert len(got) == len(rows)
    for r in got:
        letterless = r.text is None or not re.search(r"[^\W\d_]", r.text)
        assert (r.lang_pred == "und") == letterless and r.lang_pred in ("und", "en")
        assert not letterless or (r.score == 0.0 and r.rejected)
    assert language.identified(df.limit(0)).count() == 0
    unlabelled = language.identified(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_centroids_part_what_is_apart():
    rng = np.random.default_rng(1)
    base = np.eye(3, 40, dtype=np.float32)
    vectors = np.concatenate([b + 0.05 * rng.random((30, 40), np.float32) for b in base])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, least = language.cluster(vectors.astype(np.float32), 3)
    owner = np.argmax(vectors @ centres.T, axis=1)
    assert len({tuple(owner[i : i + 30]) for i in (0, 30, 60)}) == 3 and (least > 0.9).all()


def test_lone_outliers_become_no_centroids():
    rng = np.random.default_rng(4)
    usual = np.eye(1, 40, dtype=np.float32) + 0.05 * rng.random((60, 40), np.float32)
    vectors = np.concatenate([usual, np.eye(40, dtype=np.float32)[30:33]])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, _ = language.cluster(vectors.astype(np.float32))
    assert (centres @ vectors[0] > 0.9).all()


def test_texts_of_no_learnt_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()))
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)) for n in (16, 64, 500) for _ in range(5)]
    foreign = [
        "".join(rng.choices(letters, k=2000)),
        "Tämä on tavallinen suomenkielinen lause, jossa kerrotaan miten kaupungin asukkaat viettävät kesäisin aikaansa järvellä",
        "To jest zwykłe polskie zdanie, w którym opowiada się o tym, jak mieszkańcy miasta spędzają czas latem nad jeziorem",
        "Bu, şehir sakinlerinin yazın göl kenarında nasıl vakit geçirdiklerini anlatan sıradan bir Türkçe cümledir",
    ]
    odd = spark.createDataFrame([(t,) for t in [*words, *foreign]], "text string")
    kept = odd.select("text", language.predict("text", model).alias("f")).filter("NOT f.rejected").collect()
    assert kept == []
    held = docs.filter(language.held_out()).filter("text RLIKE '[a-z]{2}'")
    for size in (10, 30, 100, 100_000):
        short = held.select(F.substring("text", 1, size).alias("text"))
        gone = short.filter(language.predict("text", model)["rejected"]).count()
        assert gone <= 0.005 * held.count(), size
    # Without one language its texts are of none.
    model = language.fit(docs.filter("lang <> 'es'"))
    unlearnt = docs.filter("lang = 'es' AND n_chars > 300")
    assert unlearnt.filter(language.predict("text", model)["rejected"]).count() >= 0.97 * unlearnt.count()


def _plain_vector(text, weights):
    """n-grams counted one by one in a dictionary."""
    words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
    data = f" {' '.join(words)} ".encode()
    found = Counter()
    for i in range(len(data) - 1):
        found[(data[i] << 8 | data[i + 1] | 1 << 24) * 2654435761 % 2**32 >> 20] += 1
        if i + 2 < len(data):
            found[(data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % 2**32 >> 20] += 1
    vector = {g: math.log1p(n) * float(weights[g]) for g, n in found.items()}
    length = math.sqrt(sum(x * x for x in vector.values()))
    return {g: x / length for g, x in vector.items()} if words else None


def test_the_nearest_centroid_is_the_nearest(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~language.held_out()))
    got = {r.doc_id: r.f for r in docs.select("doc_id", language.predict("text", model).alias("f")).collect()}
    for row in docs.collect():
        vector = _plain_vector(row.text or "", model.weights)
        if vector is None:
            assert got[row.doc_id][:2] == ("und", 0.0)
            continue
        cosines = [sum(x * float(c[g]) for g, x in vector.items()) for c in model.centroids]
        best = max(cosines)
        near = {name for name, x in zip(model.languages, cosines, strict=True) if x > best - 1e-5}
        assert got[row.doc_id].lang_pred in near and got[row.doc_id].score == pytest.approx(min(1, max(0, best)), abs=1e-5)


def test_numbers_are_no_letters(spark):
    docs = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("el gato y el perro", "es")] * 20)]
    model = language.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    odd = ["½ ²", "²³", "Ⅷ ①", "12 _ !", "", None, "\u0301"]
    rows = spark.createDataFrame([(t,) for t in odd], "text string").select(language.predict("text", model).alias("f")).collect()
    assert [r.f.lang_pred for r in rows] == ["und"] * len(odd)
    letters = spark.createDataFrame([("ª½",), ("ǅ",), ("中",)], "text string").select(language.predict("text", model).alias("f"))
    assert all(r.f.lang_pred in ("en", "es") for r in letters.collect())


def test_a_repeated_row_teaches_once(spark, monkeypatch):
    """One id, or many equal rows, may fill the table: the sample stays near its bound."""
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 50)
    seen, real = [], language.cluster
    monkeypatch.setattr(language, "_limits", lambda q, one: (seen.append(q), np.zeros(language.STEPS, np.float32))[1])
    rows = [(7, f"word{i} the and", "en") for i in range(4000)] + [(8, "same text", "en")] * 4000 + [(9, "el gato", "es")] * 3000
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = max(n for (one, _), (_, n) in seen[0].items() if one == "en")
    assert 10 < texts < 400 and set(model.languages) == {"en", "es"} and real is language.cluster


def test_language_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "the cat", "en", 5, 6, 7), (2, "el gato", "es", 8, 9, 10)], "doc_id long, text string, lang string, _found int, row int, `a.b` int")
    got = language.identified(df)
    assert got.columns == [*df.columns, "lang_pred", "score", "rejected"]
    assert sorted(tuple(r)[3:6] for r in got.collect()) == [(5, 6, 7), (8, 9, 10)]
    assert language.identified(df.limit(0)).collect() == []


def _brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m.group())) <= 19 and tagger.luhn(digits(m.group())):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


PARTS = ["a", "b@", "@", "c.d", ".", "1", "25", "0", "12.", "-", " ", "+", "+1", "(", "é", "4111111111111111", "_", "256", "..", "a@b.c"]


def test_base_spans_are_the_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert [s[:3] for s in pii.base_spans(text)] == _brute(text), text


def test_base_spans_of_very_long_runs():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000):
        pii.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    shapes = [p.shape for p in tagger.trained(48, 1)]
    w = tagger.Weights(*[rng.normal(0, 0.3, s) for s in shapes])
    codes, labels = rng.integers(0, 100, (2, 6)), rng.integers(0, 9, (2, 6))

    def loss():
        return tagger.crf_gradient(tagger.forward(w, codes)[0], labels, w.moves, w.first)[0]

    scores, kept = tagger.forward(w, codes)
    _, (d_scores, d_moves, d_first) = tagger.crf_gradient(scores, labels, w.moves, w.first)
    for p, g in zip(w, [*tagger.backward(w, kept, d_scores), d_moves, d_first], strict=True):
        at = np.unravel_index(np.argmax(abs(g)), g.shape)
        p[at] += 1e-4
        up = loss()
        p[at] -= 2e-4
        down = loss()
        p[at] += 1e-4
        assert g[at] == pytest.approx((up - down) / 2e-4, rel=0.02)


def test_decoding_is_the_best_sequence():
    rng = np.random.default_rng(2)
    scores, moves, first = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    best = max(
        np.ndindex(3, 3, 3, 3),
        key=lambda y: first[y[0]] + sum(scores[0, t, y[t]] for t in range(4)) + sum(moves[y[t], y[t + 1]] for t in range(3)),
    )
    assert tuple(tagger.decode(scores, moves, first)[0]) == best


def test_tagger_finds_held_out_spans():
    weights, total, hit = tagger.trained(), 0, 0
    texts = list(tagger.examples(200, 99))
    for (text, spans), found in zip(texts, pii.spans_of([t for t, _ in texts], weights), strict=True):
        got = {(s.kind, s.start, s.end) for s in found}
        assert [s[:3] for s in found if s.base] == [s[:3] for s in sorted(pii.base_spans(text), key=lambda s: (pii.KINDS.index(s.kind), s.start))]
        total += len(spans)
        hit += sum(s in got for s in spans)
    assert hit >= 0.8 * total
    joined = "ask +1 (269) 555-3296 4524132264652876 now"
    assert [(s.kind, joined[s.start : s.end]) for s in pii.spans_of([joined], weights)[0]] == [
        ("card", "4524132264652876"),
        ("phone", "+1 (269) 555-3296"),
    ]
    plain = ["no numbers here", "version 2.0 of 2024-01-02", "CC BY-NC 4.0.", "password=b7db7aa4a5fcc78305"]
    assert pii.spans_of(plain, weights) == [[], [], [], []]


def test_every_span_that_can_pass_is_in_a_window():
    """Windows that hold an @ or digits of any such span are read, and those beside them; look-alikes alone are not."""
    rng = random.Random(3)
    personal = ["a @ b.co", "1 . 2 . 3 . 4", "4111/1111/1111/1111", "(269) 555-3296 7", "x@y", "0044 20 7946 0958"]
    other = ["page 12 of 340", "version 2.0", "2024-01-02", "#5"]
    for _ in range(500):
        text, spans = "", []
        for _ in range(rng.randint(0, 4)):
            text += "x" * rng.randint(0, 150) + " " + rng.choice(other) + " y "
            part = rng.choice(personal)
            held = re.search("@|[0-9].*[0-9]", part)
            spans.append((len(text) + held.start(), len(text) + held.end()))
            text += part + " z"
        last = max(0, -(-(len(text) - pii.WINDOW) // pii.STRIDE))
        runs = list(pii._runs(text))
        read = {w for a, b in runs for w in range(a, b + 1)}
        for a, b in spans:
            blocks = [w for w in range(last + 1) if w * pii.STRIDE < b and a < w * pii.STRIDE + pii.WINDOW]
            assert {min(max(w + d, 0), last) for w in blocks for d in (-1, 0, 1)} <= read
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))
    assert not list(pii._runs("page 12 of 340, version 2.0 of 2024-01-02, $5.99 " * 100))


def test_a_long_run_is_decoded_in_parts(monkeypatch):
    """Parts that overlap give the spans of the whole run, but for a rare one that hangs on rounding."""
    weights, rng = tagger.trained(), random.Random(6)
    spans = ["4111 1111 1111 1111", "+1 (269) 555-3296", "10 . 0 . 0 . 7", "1/2/3/4/5/6/7/8/9/0"]
    text = " ".join(rng.choice(spans) + rng.choice(("", " ab", ",")) for _ in range(900))
    assert len(list(pii._parts([text]))) == 1
    whole = pii.spans_of([text], weights)
    monkeypatch.setattr(pii, "RUN_WINDOWS", 64)
    monkeypatch.setattr(pii, "SLICE_WINDOWS", 100)
    parts = list(pii._parts([text]))
    assert len(parts) > 6 and all(p.last - p.first < 64 for p in parts)
    assert [(p.begin, p.end) for p in parts][1:] == list(zip([p.end for p in parts], [p.end for p in parts][1:]))
    again = pii.spans_of([text], weights)
    assert len(whole[0]) > 300 and len(set(again[0]) ^ set(whole[0])) <= 0.01 * len(whole[0])


def test_many_addresses_are_merged_in_order():
    text = " ".join(f"u{i}@mail{i}.com or v{i} @ host{i}.org" for i in range(20_000))
    base, at, tagged = pii.base_spans(text), 0, []
    for i in range(20_000):
        at = text.index(f"v{i} @", at)
        tagged.append(("email", at, at + len(f"v{i} @ host{i}.org")))
        tagged.append(("email", at - 8, at - 2))  # touches a base span
    begun = time.perf_counter()
    found = pii.with_tagged(text, base, iter(tagged))
    assert time.perf_counter() - begun < 2 and len(base) == 20_000 and len(found) == 40_000


def test_long_loose_addresses_at_every_alignment():
    rng = random.Random(8)
    part = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    cases = []
    for n in (17, 22, 28, 34, 40):
        for shift in range(pii.STRIDE):
            before = (" ".join(rng.choices(["the", "von", "rest", "house", "und"], k=40))[: 63 + shift]) + " "
            for local, host in ((part(n), "mail.com"), (part(8), part(n - 4) + ".org")):
                address = f"{local}{rng.choice((' @ ', '@ ', ' @'))}{host}"
                text = f"{before}{address} and the rest of the line goes on for a while here"
                cases.append((text, (len(before), len(before) + len(address))))
    found = pii.spans_of([t for t, _ in cases], tagger.trained())
    mails = [[(s.start, s.end) for s in spans if s.kind == "email"] for spans in found]
    assert all(m in ([], [span]) for m, (_, span) in zip(mails, cases, strict=True))
    assert sum(map(bool, mails)) >= 0.97 * len(cases)


def test_runs_are_decoded_as_each_alone():
    rng = np.random.default_rng(5)
    weights = tagger.trained(48, 1)
    runs = [rng.normal(size=(n, tagger.LABELS)).astype(np.float32) for n in (64, 65, 127, 96, 1, 64, 300)]
    for run, labels in zip(runs, tagger.best_labels(weights, runs), strict=True):
        moves, first = tagger.allowed()
        assert (labels == tagger.decode(run[None], weights.moves + moves, weights.first + first)[0]).all()


def test_columns(spark, odd_rows):
    rows = [*odd_rows, (20, "mail a@b.cd and a@b.cd, 10.0.0.1"), (21, "x" * 100_000 + " a@b.cd")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    got = {r.doc_id: r for r in pii.find_personal(df).collect()}
    assert [(s.kind, s.start, s.end) for s in got[20].spans] == [("email", 5, 11), ("email", 16, 22), ("ip", 24, 32)]
    assert got[3].spans == got[4].spans == [] and got[21].spans[0].start == 100_001
    masked = {r.doc_id: r.text for r in df.withColumn("text", pii.masked("text", tagger.trained())).collect()}
    assert masked[20] == "mail <EMAIL> and <EMAIL>, <IP>" and masked[3] is None and masked[1] == "one two  three"
