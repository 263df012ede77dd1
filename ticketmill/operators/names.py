"""Known-name mentions: a names table matched against texts, as PERSON spans."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.detectors import Detector
from ..functions.span_udfs import span_lists
from ..functions.spans import SPANS
from ..functions.text import WORD_CHAR, strip, word_count
from ..session import run_folder
from ..sources.ranges import located
from .redaction import analyze, redact_spans

# A names table up to this size is shipped to every task; beyond, tasks read it part by part.
MAX_NAMES = 500_000
MAX_NAME_BYTES = 32 * 1024 * 1024
NAME_SCORE = 0.85
# A part holds about so many names and bytes, and a task so many bytes of rows while it reads the parts.
# As Python's own objects and arrays of places the rows take some ten times these bytes.
PART_NAMES = 200_000
PART_BYTES = 16 * 1024 * 1024
HELD_BYTES = 16 * 1024 * 1024
HASHED = 100_000  # stretches of text that are taken out of the texts at a time
_RUNS = re.compile(r"\w+")


class NameStats(NamedTuple):
    """What the scan of a text must know of the names."""

    names: int
    size: int  # bytes
    runs: tuple[int, ...]  # word runs a name may have
    head: int  # characters before the first word run, at most
    tail: int  # and after the last one

    @property
    def fits(self) -> bool:
        return self.names <= MAX_NAMES and self.size <= MAX_NAME_BYTES


def _grams(text: str, counts: tuple[int, ...]) -> Iterator[tuple[int, int, str]]:
    """Texts from the start of a word run to the end of the run with which it makes one of ``counts``."""
    runs = [m.span() for m in _RUNS.finditer(text)]
    for i, (begin, _) in enumerate(runs):
        for n in counts:
            if i + n > len(runs):
                break
            end = runs[i + n - 1][1]
            yield begin, end, text[begin:end]


def clean_names(names: DataFrame, column: str) -> DataFrame:
    """The distinct names, without those that have no word: see `unmatchable_names`.

    ``core`` goes from the first word run to the last one, ``head`` and ``tail`` are
    the other characters around it.
    """
    stripped = names.select(strip(F.col(column)).alias("name")).filter(F.length("name") > 0).distinct()
    parts = rf"(?s)^([^\p{{L}}\p{{N}}_]*)({WORD_CHAR}(?:.*{WORD_CHAR})?)([^\p{{L}}\p{{N}}_]*)$"
    cut = [F.regexp_extract("name", parts, i).alias(n) for i, n in enumerate(("head", "core", "tail"), 1)]
    return stripped.select("name", *cut).filter(F.col("core") != "")


def unmatchable_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Names without a letter, digit or underscore: no mention of them can be told from punctuation."""
    stripped = names.select(strip(F.col(column)).alias("name")).filter(F.length("name") > 0)
    return stripped.filter(~F.col("name").rlike(WORD_CHAR)).distinct()


def name_stats(cleaned: DataFrame) -> NameStats:
    """One aggregate; the run counts of names are few."""
    row = cleaned.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.octet_length("name")), F.lit(0)),
        F.sort_array(F.collect_set(word_count(F.col("core")).cast("int"))),
        F.coalesce(F.max(F.length("head")), F.lit(0)),
        F.coalesce(F.max(F.length("tail")), F.lit(0)),
    ).first()
    return NameStats(row[0], row[1], tuple(row[2]), row[3], row[4])


def _shipped(df: DataFrame, text: Column, names: DataFrame, stats: NameStats, out: str) -> DataFrame:
    table: dict[str, list[tuple[str, str]]] = {}
    for r in names.select("head", "core", "tail").collect():
        table.setdefault(r["core"], []).append((r["head"], r["tail"]))
    known = df.sparkSession.sparkContext.broadcast(table)

    def mentions(t: str) -> Iterator[tuple[int, int, str, float]]:
        listed = known.value
        for b, e, gram in _grams(t, stats.runs):
            for head, tail in listed.get(gram, ()):
                start = b - len(head)
                if start >= 0 and t.startswith(head, start) and t.startswith(tail, e):
                    yield start, e + len(tail), "PERSON", NAME_SCORE

    @F.arrow_udf(SPANS)
    def match(texts: pa.Array) -> pa.Array:
        return span_lists(list(mentions(t or "")) for t in texts.to_pylist())

    return df.withColumn(out, match(F.make_valid_utf8(text)))


def _hashes(texts: list[str]) -> np.ndarray:
    """64-bit hashes, the same in every process; equal hashes are always compared as texts."""
    return pd.util.hash_array(np.array(texts, dtype=object), categorize=False).view(np.int64) if texts else np.empty(0, np.int64)


_BEGUN = pa.schema(
    [("level", pa.int32()), ("hash", pa.int64()), ("text", pa.string()), ("head", pa.string()), ("tail", pa.string()), ("name", pa.bool_())]
)


def _begun(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every beginning of a core that ends with a word, by its number of words; the whole core is the name itself."""
    for batch in batches:
        levels, texts, heads, tails, whole = [], [], [], [], []
        for head, core, tail in zip(*(c.to_pylist() for c in batch.columns)):
            for level, m in enumerate(_RUNS.finditer(core), 1):
                done = m.end() == len(core)
                levels.append(level)
                texts.append(core[: m.end()])
                heads.append(head if done else "")
                tails.append(tail if done else "")
                whole.append(done)
        columns = (levels, _hashes(texts), texts, heads, tails, whole)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BEGUN)], schema=_BEGUN)


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches, or slices of large ones, that together have about HELD_BYTES."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, batch.num_rows * HELD_BYTES // max(HELD_BYTES, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if held and size + part.nbytes > HELD_BYTES:
                yield held
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield held


class _Places:
    """Stretches of the rows' texts as arrays ordered by hash: no text is held for them."""

    def __init__(self, found: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.hash, self.row, self.begin, self.end = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(self.hash)
        self.hash, self.row, self.begin, self.end = (c[order] for c in (self.hash, self.row, self.begin, self.end))


def _places(texts: list[str], stretches: Iterable[tuple[int, int, int]]) -> _Places:
    """Places of (row, begin, end), hashed some at a time."""
    found = [(np.empty(0, np.int64), *(np.empty(0, np.int32),) * 3)]
    stretches = iter(stretches)
    while some := list(islice(stretches, HASHED)):
        found.append((_hashes([texts[r][b:e] for r, b, e in some]), *np.array(some, np.int32).T))
    return _Places(found)


def _first_words(texts: list[str]) -> Iterator[tuple[int, int, int]]:
    return ((r, *m.span()) for r, t in enumerate(texts) for m in _RUNS.finditer(t))


def _one_word_on(texts: list[str], begun: Iterable[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    for r, b, e in begun:
        if m := _RUNS.search(texts[r], e):
            yield r, b, m.end()


def _mentions(texts: list[str], parts: Iterable[pa.Table]) -> dict[int, list[tuple[int, int, str, float]]]:
    """Spans of the names in the texts, by row. The parts come in the order of level and hash.

    Every word is looked up among the first words of names. What goes on like some name is
    looked up with its next word among the beginnings of that level, and so on; a place is
    looked up in the one part that can hold its hash, however many parts there are.
    """
    spans: dict[int, list[tuple[int, int, str, float]]] = {}
    level, places, begun = 1, _places(texts, _first_words(texts)), []
    for part in parts:
        levels, hashes = part["level"].to_numpy(), part["hash"].to_numpy()
        for here in np.unique(levels).tolist():
            if here != level:  # levels have no gaps: a beginning has beginnings
                level, places, begun = here, _places(texts, _one_word_on(texts, begun)), []
            first, after = np.searchsorted(levels, [here, here + 1])
            mine = hashes[first:after]
            low, high = np.searchsorted(places.hash, mine[0]), np.searchsorted(places.hash, mine[-1], "right")
            looked = places.hash[low:high]
            left, right = np.searchsorted(mine, looked), np.searchsorted(mine, looked, "right")
            counts = right - left
            hit = np.flatnonzero(counts)
            which = np.repeat(hit, counts[hit]) + low  # a hash may stand in several rows
            listed = first + np.repeat(left[hit], counts[hit]) + _numbers(counts[hit])
            for at in range(0, len(which), HASHED):
                ours, theirs = which[at : at + HASHED], part.select(_BEGUN.names[2:]).take(listed[at : at + HASHED])
                rows = zip(places.row[ours].tolist(), places.begin[ours].tolist(), places.end[ours].tolist(), *(c.to_pylist() for c in theirs.columns))
                for r, b, e, text, head, tail, name in rows:
                    t = texts[r]
                    if not t.startswith(text, b) or len(text) != e - b:
                        continue
                    if not name:
                        begun.append((r, b, e))
                    elif (start := b - len(head)) >= 0 and t.startswith(head, start) and t.startswith(tail, e):
                        spans.setdefault(r, []).append((start, e + len(tail), "PERSON", NAME_SCORE))
    return spans


def _numbers(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each count n."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _by_parts(df: DataFrame, text: Column, names: DataFrame, out: str) -> DataFrame:
    """The beginnings of names lie in the run's folder, in parts of bounded size ordered by level and hash; each task
    reads one after the other for the rows it holds, so that neither texts nor spans move."""
    spark = df.sparkSession
    folder = run_folder(spark, "names")
    schema = ", ".join(f"{f.name} {kind}" for f, kind in zip(_BEGUN, ("int", "long", "string", "string", "string", "boolean")))
    names.select("head", "core", "tail").mapInArrow(_begun, schema).distinct().write.parquet(f"{folder}/begun")
    listed = spark.read.schema(schema).parquet(f"{folder}/begun")
    size = F.octet_length("text") + F.octet_length("head") + F.octet_length("tail")
    count, held = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    parts = max(1, -(-count // PART_NAMES), -(-held // PART_BYTES))
    ordered = listed.repartitionByRange(parts, "level", "hash").sortWithinPartitions("level", "hash")
    ordered.write.parquet(f"{folder}/parts")
    schema = T.StructType([*df.schema.fields, T.StructField(out, df.select(F.array().cast(SPANS)).schema[0].dataType)])
    kept = [f.name for f in df.schema.fields if f.name != out]
    schema = T.StructType([f for f in schema.fields if f.name != out] + [schema.fields[-1]])

    def tables() -> Iterator[pa.Table]:
        system, path = located(f"{folder}/parts")
        files = system.get_file_info(fs.FileSelector(path))
        for name in sorted(x.path for x in files if x.base_name.startswith("part-")):
            table = pq.read_table(name, filesystem=system, schema=_BEGUN)
            if table.num_rows:
                yield table

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            texts = [t or "" for batch in group for t in batch.column(batch.num_columns - 1).to_pylist()]
            spans, at = _mentions(texts, tables()), 0
            for batch in group:
                arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
                found = span_lists(sorted(spans.get(r, ())) for r in range(at, at + batch.num_rows))
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*arrays, found], names=[*kept, out])

    return df.select(*[F.col(f"`{c}`") for c in kept], F.make_valid_utf8(text).alias("__text")).mapInArrow(match, schema)


def name_spans(
    df: DataFrame,
    key: str,
    text: str,
    names: DataFrame,
    name_column: str = "name",
    out: str = "name_spans",
    ship: bool | None = None,
) -> DataFrame:
    """Adds the PERSON spans of the names, of any number of words.

    A name matches as written: its first word from the start of a word run, its last
    one to the end of one, and the punctuation it has around them. A small names table
    goes to the tasks as a whole, a large one part by part; neither moves a text, and both
    give the same spans. Names without a word are listed by `unmatchable_names`.
    """
    cleaned = clean_names(names, name_column)
    stats = name_stats(cleaned)
    if ship and not stats.fits:
        raise ValueError(f"{stats.names} names of {stats.size} bytes are too many to ship")
    if stats.fits if ship is None else ship:
        return _shipped(df, F.col(text), cleaned, stats, out)
    return _by_parts(df, F.col(text), cleaned, out)


def mask_names(
    df: DataFrame,
    key: str,
    text: str,
    names: DataFrame,
    detectors: Iterable[Detector] = (),
    operators: dict[str, str] | None = None,
    **options,
) -> DataFrame:
    """The text with every known name replaced, together with other detectors' finds."""
    found = name_spans(df, key, text, names, out="__names", **options)
    sources = [F.col("__names")]
    if detectors := tuple(detectors):
        sources.append(analyze(F.col(text), detectors))
    return found.withColumn(text, redact_spans(F.col(text), sources, operators)).drop("__names")
