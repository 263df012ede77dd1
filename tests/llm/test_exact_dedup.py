"""Exact copies against plain grouping."""

import hashlib
import random
import re
from collections import defaultdict

import compare
import pytest

from ticketmill.llm import exact_dedup, queries

SCHEMA = "doc_id long, text string"


def _want(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()].append(i)
    out = []
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        kept = False
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), i == keep and not kept, digest))
            kept = kept or i == keep
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA)
    assert _got(exact_dedup.mark_copies(df)) == _want(odd_rows)


def test_many_segments_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SEGMENT_BITS", 1 << 10)
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rng.randrange(3000)}") for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert _got(exact_dedup.mark_copies(df)) == _want(rows)
    monkeypatch.setattr(exact_dedup, "SHIPPED_BYTES", 0)
    assert _got(exact_dedup.mark_copies(df)) == _want(rows)


def test_unique_rows_are_proven_unique(spark):
    rows = [(i, f"own {i}") for i in range(5000)] + [(9000, "twice"), (9001, "twice")]
    marked = exact_dedup.possible_copies(spark.createDataFrame(rows, SCHEMA), "text")
    maybe = {r.doc_id for r in marked.filter("_maybe").collect()}
    assert {9000, 9001} <= maybe and len(maybe) < 60


def test_drop_keeps_one_row_of_each_text_with_its_columns(spark, odd_rows):
    df = spark.createDataFrame([(*r, "x") for r in odd_rows], SCHEMA + ", keep_id string")
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 5, 6, 8]
    assert kept.count() == 6


def test_no_text_moves_whatever_the_size(spark, monkeypatch):
    """Beyond the filter that is sent to all tasks, digests go to its segments."""
    monkeypatch.setattr(exact_dedup, "SHIPPED_BYTES", 0)
    plans, real = [], exact_dedup.stored

    def stored(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, purpose)

    monkeypatch.setattr(exact_dedup, "stored", stored)
    df = spark.createDataFrame([(i, f"text {i % 7}") for i in range(50)], SCHEMA)
    marked = exact_dedup.mark_copies(df)
    plans.append(marked._jdf.queryExecution().executedPlan().toString())
    scanned = [p for p in plans if re.search(r"\btext#", p)]
    assert len(scanned) == 1 and "Exchange" not in scanned[0]  # texts are read once, for their digests
    assert _got(marked) == _want([(i, f"text {i % 7}") for i in range(50)])


def test_columns_named_like_the_inner_ones(spark):
    names = ["_segment", "_maybe", "_row", "_hash", "_text", "_key", "_p0", "_words", "_digest", "c0", "a.b"]
    rows = [(1, "one", *range(len(names))), (2, "one", *range(len(names))), (3, "two", *range(7, 7 + len(names)))]
    df = spark.createDataFrame(rows, ", ".join([SCHEMA, *(f"`{n}` long" for n in names)]))
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.mark_copies(df).count() == 0 and exact_dedup.drop_copies(df).count() == 0


def test_sql_twin(spark, folder):
    con = compare.connect(folder)
    for name in queries.ORACLES:
        assert compare.differences(queries.QUERIES[name](spark, folder), con, queries.ORACLES[name]) is None
    con.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twins_are_registered(name):
    assert name in queries.QUERIES
