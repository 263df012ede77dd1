"""Requests are sent once whatever fails; measured times are within the sketch's bound."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticketmill.functions.detectors import EMAIL, IP
from ticketmill.operators import durations, ledger
from ticketmill.plans import curation


def _model(log, fail_on=None):
    """A model that notes what it is sent in a file of its own a call."""

    def call(requests):
        import os
        import uuid

        if fail_on is not None and any(fail_on == r for r in requests):
            raise RuntimeError("killed")
        with open(os.path.join(log, uuid.uuid4().hex), "w") as out:
            out.write("\n".join(requests))
        return requests.map(lambda r: f"answer to {r}")

    return call


def _sent(folder):
    return sorted(line for p in folder.iterdir() for line in p.read_text().splitlines())


def test_a_killed_run_sends_no_answered_request_again(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rows = [(i, f"r{i % 40}" if i % 9 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, request_payload string")
    with pytest.raises(Exception, match="killed"):
        ledger.with_ledger(df, _model(str(log), "r17"), str(tmp_path / "ledger"), batch=3)
    before = _sent(log)
    assert 0 < len(before) < 40
    out = ledger.with_ledger(df, _model(str(log)), str(tmp_path / "ledger"), batch=3)
    got = {r.id: r.response for r in out.collect()}
    assert got == {i: None if r is None else f"answer to {r}" for i, r in rows}
    assert _sent(log) == sorted(f"r{i}" for i in range(40)), "each distinct request once over both runs"
    again = spark.createDataFrame([(1, "r3"), (2, "new")], "id long, request_payload string")
    ledger.with_ledger(again, _model(str(log)), str(tmp_path / "ledger")).collect()
    assert _sent(log) == sorted([*(f"r{i}" for i in range(40)), "new"])


def test_the_ledger_query_reads_its_tickets_once(spark, tmp_path):
    """What the two runs and the result ask for is made by one pass of Python over the tickets."""
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    rows = [(i, i % 3, "F", 1.0, None, "5-LOW") for i in range(60)]
    spark.createDataFrame(rows, orders).write.parquet(str(tmp_path / "orders.parquet"))
    people = [(i, f"Customer#{i}", 1, 1.0, "MACHINERY") for i in range(3)]
    spark.createDataFrame(people, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    out = curation.model_ledger(spark, str(tmp_path))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["ticket_id"]: r for r in out.collect()}
    assert len(got) == 60 and {r["sent_again"] for r in got.values()} == {0}
    assert all((r["response"] is None) == (i % 29 in (1, 2, 3, 4)) for i, r in got.items())


def test_a_repeated_batch_is_read_not_sent(tmp_path):
    calls = []

    def call(requests):
        calls.append(list(requests))
        return requests.str.upper()

    for _ in range(2):
        assert ledger._answered(str(tmp_path), ["h1", "h2"], ["a", "b"], call) == ["A", "B"]
    assert calls == [["a", "b"]]
    with pytest.raises(ValueError, match="1 answers to 2"):
        ledger._answered(str(tmp_path), ["h3", "h4"], ["a", "b"], lambda r: r[:1])


def test_calls_are_tried_again():
    waits, calls = [], []

    def call(requests):
        calls.append(len(requests))
        if len(calls) < 3:
            raise TimeoutError
        return requests

    got = ledger.attempted(call, pd.Series(["a"]), (TimeoutError,), 5, waits.append)
    assert list(got) == ["a"] and len(calls) == 3 and len(waits) == 2 and all(1 <= w <= 4 for w in waits)
    with pytest.raises(KeyError):
        ledger.attempted(lambda r: {}["x"], pd.Series(["a"]), (TimeoutError,), 5, waits.append)
    with pytest.raises(TimeoutError):
        ledger.attempted(lambda r: (_ for _ in ()).throw(TimeoutError()), pd.Series(["a"]), (TimeoutError,), 2, waits.append)


def test_detectors_are_timed(spark):
    rows = [("mail a@b.com or 10.0.0.1",), ("nothing",), ("",), (None,), ("a@b.com a@c.com " * 50,)] * 20
    sketch = durations.timed(spark.createDataFrame(rows, "text string").repartition(5), "text", [EMAIL, IP])
    got = {r.entity: r for r in durations.quantiles(sketch).collect()}
    assert {e: (r.texts, r.matches) for e, r in got.items()} == {EMAIL.entity: (60, 2020), IP.entity: (60, 20), "text": (60, 2040)}
    assert all(0 < r.p50 <= r.p95 <= r.p99 for r in got.values())
    assert got["text"].seconds == pytest.approx(got[EMAIL.entity].seconds + got[IP.entity].seconds)
    assert durations.timed(spark.createDataFrame([], "text string"), "text", [EMAIL]).count() == 0


def test_quantiles_are_within_the_bound(spark):
    rng = random.Random(4)
    times = [rng.lognormvariate(-9, 2) for _ in range(3000)]
    rows = [("x", durations.bucket(t), 1, 0, t) for t in times]
    sketch = spark.createDataFrame(rows, "entity string, bucket int, texts long, matches long, seconds double")
    sketch = sketch.groupBy("entity", "bucket").agg(*[F.sum(c).alias(c) for c in ("texts", "matches", "seconds")])
    got = durations.quantiles(sketch, (0.1, 0.5, 0.9, 0.99)).first()
    for share, value in zip((0.1, 0.5, 0.9, 0.99), (got["p10"], got["p50"], got["p90"], got["p99"])):
        exact = sorted(times)[-(-int(share * 3000 * 10) // 10) - 1]
        assert value == pytest.approx(exact, rel=durations.ACCURACY * 1.01)


def test_slow_texts_are_those_measured(spark):
    rows = [(1, "x"), (2, None), (3, "a@b.com " * 20_000)]
    df = spark.createDataFrame(rows, "id long, text string")
    assert [r.id for r in durations.slow_texts(df, "id", "text", [EMAIL], 0.002).collect()] == [3]
    assert durations.slow_texts(df, "id", "text", [EMAIL], 1e9).count() == 0
