"""Language of a text by the nearest of several centroids per language.

A text is a vector of hashed letter n-grams (two and three bytes of its lower-cased
UTF-8, letters and word borders only), weighted by log(1 + count) and the inverse
document frequency, and scaled to length one. Per language, spherical k-means over
labelled texts gives a few centroids, none of them of a few outliers alone. A text gets
the language of the centroid with the greatest cosine, and is rejected when that is far
below what labelled texts of that language and of that length have. Length is the number
of different n-grams, in steps of doubling; the usual cosine of each step is a low
quantile over pieces of the labelled texts, so short texts are held to what short pieces
have.

The model is fitted on a sample of about SAMPLE_PER_LANGUAGE different labelled rows of
each language, chosen by the hash of id and text; whole texts are read. One task fits one
language. Only counts per language, the document frequencies, the centroids and STEPS
quantiles per language reach the driver: DIMENSIONS numbers each at most.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and
rejected; ties go to the language that sorts first; a null label teaches nothing;
without labelled rows every text is ``und``; repeated rows are predicted alike and teach
once; a very long text is one vector like any other; an empty table gives no rows; columns
named like the new ones are replaced, all others pass unchanged; a step
with fewer than LEAST_PIECES pieces takes the limit of all languages together, then that
of the step below, and without any nothing is rejected.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 800
ROUNDS = 12
MAX_LANGUAGES = 1000  # more labels than that are no languages
LEAST_MEMBERS = 0.05  # of a language's texts; a smaller cluster goes to the others
# A text is rejected below this share of a low quantile of what labelled pieces of its length have.
REJECT_SHARE = 0.45
QUANTILE = 0.01
PIECES = 2  # of a text and length
LEAST_PIECES = 20
STEPS = DIMENSIONS.bit_length()  # of length, each twice the one before
UNKNOWN = "und"


def _no_letters() -> str:
    """A class of all characters that are no letters: those of words less digits and other numbers."""
    numbers = [c for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nl", "No")]
    first = [c for i, c in enumerate(numbers) if i == 0 or numbers[i - 1] != c - 1]
    last = [c for i, c in enumerate(numbers) if i + 1 == len(numbers) or numbers[i + 1] != c + 1]
    return r"[\W\d_" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(first, last, strict=True)) + "]+"


_NO_LETTER = re.compile(_no_letters())


class Model(NamedTuple):
    languages: list[str]  # of each centroid, sorted
    centroids: np.ndarray  # a row each, of length one
    limits: np.ndarray  # a row each, by length: below it a text is rejected
    weights: np.ndarray  # inverse document frequencies


def counts(text: str | None) -> np.ndarray | None:
    """n-grams by hashed number; None for a text without letters."""
    data = _NO_LETTER.sub(" ", (text or "").lower()).strip()
    if not data:
        return None
    b = np.frombuffer(f" {data} ".encode(), np.uint8).astype(np.uint32)
    two = b[:-1] << 8 | b[1:]
    three = two[:-1] << 8 | b[2:]
    grams = np.concatenate([two | 1 << 24, three])
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)


def vector(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    v = np.log1p(found.astype(np.float32)) * weights
    return v / max(float(np.linalg.norm(v)), 1e-12)


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length one, and the least cosine of each one's members."""
    k = min(k, len(vectors))
    fewest = min(len(vectors), max(2, int(LEAST_MEMBERS * len(vectors))))
    chosen = [0]  # the first row, then always one far from those chosen, but no outlier
    near = vectors @ vectors[0]
    while len(chosen) < k:
        chosen.append(int(np.argsort(near, kind="stable")[len(vectors) // 10]))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen].copy()
    while True:
        for _ in range(rounds):
            owner = np.argmax(vectors @ centres.T, axis=1)
            for c in range(len(centres)):
                if (owner == c).any():
                    mean = vectors[owner == c].sum(axis=0)
                    centres[c] = mean / max(float(np.linalg.norm(mean)), 1e-12)
        members = np.bincount(np.argmax(vectors @ centres.T, axis=1), minlength=len(centres))
        if members.min() >= fewest:
            break
        centres = np.delete(centres, int(members.argmin()), axis=0)
    cosine = vectors @ centres.T
    owner = np.argmax(cosine, axis=1)
    least = [cosine[owner == c, c].min(initial=1.0) for c in range(len(centres))]
    return centres, np.array(least, np.float32)


def step(found: np.ndarray) -> int:
    """The length of a text: the number of its different n-grams, as a power of two."""
    return int(np.count_nonzero(found)).bit_length() - 1


def pieces(text: str) -> Iterator[str]:
    """A text, and pieces of it in all lengths, dealt evenly over it."""
    yield text
    text = _NO_LETTER.sub(" ", text.lower()).strip()
    size = 4
    while size < len(text):
        for i in range(PIECES):
            at = (2 * i + 1) * (len(text) - size) // (2 * PIECES)
            yield text[at : at + size]
        size *= 2


def _limits(quantiles: dict[tuple[str | None, int], tuple[float, int]], language: str) -> np.ndarray:
    """By length, the cosine below which a text is rejected; (None, step) are the values of all languages together."""
    limits, limit = np.zeros(STEPS, np.float32), 0.0
    for at in range(STEPS):
        for key in ((language, at), (None, at)):
            value, n = quantiles.get(key, (0.0, 0))
            if n >= LEAST_PIECES:
                limit = value * REJECT_SHARE
                break
        limits[at] = limit
    return limits


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column("_text"):
            found = counts(text.as_py())
            if found is not None:
                total += found > 0
                rows += 1
    place = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, place].astype(np.int32)), pa.array(np.r_[rows, total[place]].astype(np.int64))], names=["place", "n"]
    )


def fit(df: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id") -> Model:
    """Learn from the rows of ``df`` that have a label."""
    # Rows equal in id and text are one: they would be drawn together, however many there are.
    rows = df.select(F.col(label).cast("string").alias("_label"), text_of(text).alias("_text"), F.col(key).alias("_id"))
    rows = rows.filter("_label IS NOT NULL").withColumn("_hash", F.xxhash64("_id", "_text"))
    sizes = rows.groupBy("_label").agg(F.approx_count_distinct("_hash").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"{label} has more than {MAX_LANGUAGES} values")
    shares = [(r["_label"], SAMPLE_PER_LANGUAGE / r["n"]) for r in sizes]
    share = df.sparkSession.createDataFrame(shares, "_label string, _share double")
    sample = (
        rows.join(F.broadcast(share), "_label")
        .filter(F.pmod("_hash", F.lit(1 << 20)) < F.col("_share") * (1 << 20))
        .groupBy("_label", "_hash")
        .agg(F.min("_text").alias("_text"))
        .select("_label", "_text")
    )
    known = dict(sample.mapInArrow(_frequencies, "place int, n long").groupBy("place").agg(F.sum("n")).collect())
    texts = known.pop(-1, 0)
    seen = np.zeros(DIMENSIONS)
    seen[list(known)] = list(known.values())
    weights = np.log((1 + texts) / (1 + seen)).astype(np.float32) + 1

    def learn(rows: pa.Table) -> pa.Table:
        found = (counts(t.as_py()) for t in rows["_text"])
        vectors = np.array([vector(f, weights) for f in found if f is not None], np.float32).reshape(-1, DIMENSIONS)
        centres = cluster(vectors)[0] if len(vectors) else vectors
        return pa.table(
            {
                "language": pa.array([rows["_label"][0].as_py()] * len(centres), pa.string()),
                "centre": pa.array([c.tobytes() for c in centres], pa.binary()),
            }
        )

    learnt = sample.groupBy("_label").applyInArrow(learn, "language string, centre binary").collect()
    learnt = sorted(learnt, key=lambda r: (r.language, r.centre))
    centroids = np.array([np.frombuffer(r.centre, np.float32) for r in learnt], np.float32).reshape(-1, DIMENSIONS)
    languages = [r.language for r in learnt]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, float]] = []
            for label, text in zip(batch["_label"].to_pylist(), batch["_text"].to_pylist(), strict=True):
                some = [c for c in map(counts, pieces(text)) if c is not None]
                if not some:
                    continue
                cosine = np.array([vector(c, weights) for c in some]) @ centroids.T
                # A piece nearest to another language teaches nothing: its label may be wrong.
                best = [(languages[i], step(c), float(row[i])) for c, row, i in zip(some, cosine, cosine.argmax(axis=1), strict=True)]
                out += [b for b in best if b[0] == label]
            columns = [pa.array([o[i] for o in out], k) for i, k in enumerate((pa.string(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["language", "step", "cosine"])

    judged = sample.mapInArrow(judge, "language string, step int, cosine double")
    low = judged.groupingSets([["language", "step"], ["step"]], "language", "step").agg(
        F.percentile_approx("cosine", QUANTILE, 10_000).alias("low"), F.count("*").alias("n")
    )
    quantiles = {(r["language"], r["step"]): (r["low"], r["n"]) for r in low.collect()}
    limits = np.array([_limits(quantiles, one) for one in languages], np.float32).reshape(-1, STEPS)
    return Model(languages, centroids, limits, weights)


def predict(text: Column | str, model: Model) -> Column:
    """lang_pred, score and rejected of a text."""

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [(UNKNOWN, 0.0, True)] * len(batch)
            for at in range(0, len(batch), 256):
                some = [(i, counts(batch[i].as_py())) for i in range(at, min(at + 256, len(batch)))]
                some = [(i, c) for i, c in some if c is not None]
                if not some or not model.languages:
                    continue
                cosine = np.array([vector(c, model.weights) for _, c in some]) @ model.centroids.T
                best = np.argmax(cosine, axis=1)
                score = cosine[np.arange(len(some)), best]
                for (i, own), c, s in zip(some, best, score, strict=True):
                    found[i] = (model.languages[c], min(1.0, max(0.0, float(s))), bool(s < model.limits[c, step(own)]))
            columns = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "rejected"])

    return nearest(text_of(text))


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is left out of learning: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``df`` with lang_pred, score and rejected, learnt from the rows that aren't held out."""
    model = fit(df.filter(~held_out(key) & F.col(key).isNotNull()), label, text, key)
    kept = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]
    # The row's own columns stand apart, so none can clash with the inner ones.
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    found = df.select(row.alias("row"), predict(text, model).alias("found"))
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], "found.*")
