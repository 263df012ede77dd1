"""Streaming operators against their batch twins: many files, disorder, restarts."""

import random

import compare
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticketmill.functions import folds
from ticketmill.functions.text import strip
from ticketmill.operators import gates, monitor, sequence
from ticketmill.streaming import folds as state
from ticketmill.streaming import jobs

SCHEMA = "key string, ts timestamp, id long, bad boolean"


def _rows(n, seed=3):
    rng = random.Random(seed)
    return [(f"k{rng.randrange(4)}", i * 1_500_000 + rng.randrange(900_000), i, rng.random() < 0.4) for i in range(n)]


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "key string, us long, id long, bad boolean")
    return df.select("key", F.timestamp_micros("us").alias("ts"), "id", "bad")


def _put(spark, rows, path, number):
    _frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{path}/f{number:03d}")


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def _x():
    return {"x": F.when(F.col("bad"), 1.0).otherwise(0.0)}


def _by_id(df, *columns):
    rows = df.collect()
    got = {r["id"]: tuple(r[c] for c in columns) for r in rows}
    assert len(got) == len(rows), "a row came out twice"
    return got


def test_arrival_order_with_a_restart(spark, tmp_path):
    rows = _rows(300)
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    for number, at in enumerate(range(0, 300, 60)):
        if number == 3:  # the first files are drained before the others exist
            jobs.append_to(state.stream_fold(_stream(spark, src), "key", "ts", "id", _x(), folds.Ema(0.05)), out, ckpt).awaitTermination()
        _put(spark, rows[at : at + 60], src, number)
    jobs.append_to(state.stream_fold(_stream(spark, src), "key", "ts", "id", _x(), folds.Ema(0.05)), out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.filter("late").count() == 0
    want = _by_id(sequence.ema(_frame(spark, rows), "key", ["ts", "id"], F.col("bad")), "ema")
    have = _by_id(got, "ema")
    assert have.keys() == want.keys()
    assert all(have[i][0] == pytest.approx(want[i][0], abs=1e-12) for i in want)


def test_late_rows_are_returned_not_folded(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _put(spark, [("a", 10_000_000, 1, True), ("a", 20_000_000, 2, True)], src, 0)
    stream = lambda: state.stream_fold(_stream(spark, src), "key", "ts", "id", _x(), folds.Ema(0.5))
    jobs.append_to(stream(), out, ckpt).awaitTermination()
    _put(spark, [("a", 15_000_000, 3, True), ("a", 30_000_000, 4, False)], src, 1)
    jobs.append_to(stream(), out, ckpt).awaitTermination()
    got = _by_id(spark.read.parquet(out), "late", "ema")
    assert got == {1: (False, 0.5), 2: (False, 0.75), 3: (True, None), 4: (False, 0.375)}


@pytest.mark.parametrize("kind", ["streak", "reset"])
def test_watermark_restores_event_time_order(spark, tmp_path, kind):
    """Rows shuffled within the delay, over several files and a restart."""
    rows = _rows(240, seed=8)
    rng = random.Random(1)
    shuffled = [r for at in range(0, 240, 20) for r in rng.sample(rows[at : at + 20], 20)]
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    fold, inputs = {
        "streak": (folds.Streak(), {"bad": F.col("bad")}),
        "reset": (folds.ResettingEma(0.05, 0.1, 0.2), _x()),
    }[kind]

    def run():
        stream = state.stream_fold(_stream(spark, src), "key", "ts", "id", inputs, fold, delay="40 seconds")
        jobs.append_to(stream, out, ckpt).awaitTermination()

    for number, begin in enumerate(range(0, 240, 48)):
        _put(spark, shuffled[begin : begin + 48], src, number)
        if number == 2:
            run()
    run()
    names = [n for n, _ in fold.outputs]
    done = spark.read.parquet(out)
    # The last rows wait for a watermark that does not come; they are folded from the state.
    rest = state.waiting(spark, ckpt, _frame(spark, rows), "key", "ts", "id", inputs, fold)
    assert 0 < rest.count() < 240 and done.count() > 0
    have = _by_id(done.unionByName(rest), *names)
    batch = {
        "streak": lambda df: sequence.failure_streaks(df, "key", ["ts", "id"], F.col("bad")),
        "reset": lambda df: sequence.ema_with_resets(df, "key", ["ts", "id"], F.col("bad"), warn=0.1, stop=0.2),
    }[kind](_frame(spark, rows))
    want = _by_id(batch, *names)
    assert have.keys() == want.keys()
    for i in want:
        for a, b in zip(have[i], want[i]):
            assert a == (pytest.approx(b, abs=1e-9) if isinstance(b, float) else b)


def test_rows_without_a_time_are_late(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _put(spark, [("a", 10_000_000, 1, True), ("a", None, 2, True), ("b", None, 3, True)], src, 0)
    fold = folds.Ema(0.5)
    jobs.append_to(state.stream_fold(_stream(spark, src), "key", "ts", "id", _x(), fold), out, ckpt).awaitTermination()
    rows = spark.read.parquet(out)
    assert _by_id(rows, "late", "ema") == {1: (False, 0.5), 2: (True, None), 3: (True, None)}
    again = lambda df: sequence.ema(df, "key", ["ts", "id"], F.col("bad"), 0.5)
    assert _by_id(state.settled(rows, "key", fold, again), "ema") == {2: (0.5,), 1: (0.75,), 3: (0.5,)}


def test_streams_read_a_folder_of_part_files_and_lose_no_row(spark, folder, tmp_path):
    """The event log as 12 shuffled part files, one to a trigger: every registered stream over it."""
    from ticketmill.plans import streams

    table = spark.read.parquet(f"{folder}/events.parquet")
    table.orderBy(F.rand(3)).repartition(12).write.parquet(str(tmp_path / "events.parquet"))
    con = compare.connect(folder)
    try:
        real = jobs.stream_table
        streams.jobs.stream_table = lambda s, f, name: real(s, f, name, 3)
        for name in ("stream_ema", "stream_ema_resets", "stream_streaks", "stream_progress", "stream_recent_bad"):
            assert compare.differences(streams.QUERIES[name](spark, str(tmp_path)), con, streams.ORACLES[name]) is None, name
    finally:
        streams.jobs.stream_table = real
        con.close()


def test_recent_rows_over_many_files(spark, tmp_path):
    rows = _rows(200, seed=5)
    src = str(tmp_path / "in")
    for number, at in enumerate(range(0, 200, 50)):
        _put(spark, rows[at : at + 50], src, number)
    bad = _stream(spark, src).filter("bad")
    recent = state.stream_recent(bad, "key", ["ts", "id"], [], 7)
    out = jobs.drain(jobs.upsert_to, recent, str(tmp_path / "job"))
    got = spark.read.parquet(out)
    newest = got.groupBy("key").agg(F.max("batch").alias("batch"))
    have = {(r["key"], r["id"], r["age"]) for r in got.join(newest, ["key", "batch"]).collect()}
    batch = monitor.recent_bad(_frame(spark, rows), F.col("bad"), "key", ["ts", "id"], 7)
    assert have == {(r["key"], r["id"], r["age"]) for r in batch.collect()}


def test_progress_over_many_files(spark, tmp_path):
    rows = _rows(200, seed=6)
    src = str(tmp_path / "in")
    for number, at in enumerate(range(0, 200, 50)):
        _put(spark, rows[at : at + 50], src, number)
    windows = jobs.progress_stream(_stream(spark, src), "ts", F.col("bad"), "10 minutes")
    out = jobs.drain(jobs.upsert_to, windows, str(tmp_path / "job"))
    have = {tuple(r) for r in jobs.latest(spark, out, ["window_start"]).collect()}
    want = {tuple(r) for r in monitor.progress(_frame(spark, rows), "ts", F.col("bad")).collect()}
    assert have == want


def test_lines_come_in_bounded_batches(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"f{i}.jsonl").write_text('{"a":1}\n\n')
    lines = jobs.stream_lines(spark, str(tmp_path / "*.jsonl"), max_files=2)
    query = jobs.append_to(lines.withColumn("value", strip(F.col("value"))), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [4, 4, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_routing_a_repeated_batch_changes_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("{}\n{\n[1]\n")

    def run(ckpt):
        lines = jobs.stream_lines(spark, str(src)).withColumn("response", F.lit('{"status":"bad","data":"no"}'))
        routed = gates.classify(gates.raw_tickets(lines))
        jobs.route_stream(routed, str(tmp_path / "out"), str(tmp_path / ckpt)).awaitTermination()

    def stored():
        bad = spark.read.json(str(tmp_path / "out/bad"))
        return sorted((r["raw_ticket"], r["error_class"]) for r in bad.collect())

    run("c1")
    first = stored()
    run("c2")  # a new checkpoint delivers batch 0 again
    assert first == stored() == [("[1]", "invalid_shape"), ("{", "invalid_json"), ("{}", "model_bad")]
    assert spark.read.json(str(tmp_path / "out/transactions")).count() == 1


def test_triggers_of_tables_are_bounded_by_bytes(spark, tmp_path):
    spark.range(6000).repartition(6).write.parquet(f"{tmp_path}/t.parquet")
    largest = max(f.stat().st_size for f in (tmp_path / "t.parquet").glob("part-*"))
    for bound, batches in ((largest, 6), (100 * largest, 1)):
        stream = jobs.stream_table(spark, str(tmp_path), "t", max_bytes=bound)
        query = jobs.append_to(stream, f"{tmp_path}/out{bound}", f"{tmp_path}/checkpoint{bound}")
        query.awaitTermination()
        assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == batches
        assert spark.read.parquet(f"{tmp_path}/out{bound}").count() == 6000


def test_the_default_bound_of_a_trigger_is_one_spark_takes(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    jobs.append_to(jobs.stream_table(spark, str(tmp_path), "t"), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_a_trigger_has_one_bound(spark, tmp_path):
    with pytest.raises(ValueError, match="max_files or"):
        jobs.stream_lines(spark, str(tmp_path), max_files=1, max_bytes=1)


class _MapState:
    """Map state in memory, as the state store gives it."""

    def __init__(self):
        self.held = {}
        self.most = 0

    def updateValue(self, key, value):  # noqa: N802
        self.held[key] = value

    def getValue(self, key):  # noqa: N802
        return self.held[key]

    def removeKey(self, key):  # noqa: N802
        del self.held[key]

    def iterator(self):
        return iter(list(self.held.items()))


@pytest.mark.parametrize("seed", range(20))
def test_runs_are_merged_by_slices(monkeypatch, seed):
    """Rows come out once, in order, in pieces no larger than a slice of each run; what is after the time stays."""
    monkeypatch.setattr(state, "SLICE_ROWS", 4)
    rng = random.Random(seed)
    runs = state.Runs(_MapState(), _MapState(), "id")
    left, number, taken = [], 0, []
    for step in range(6):
        for _ in range(rng.randint(0, 4)):
            new = [(rng.randint(step * 5, 60), 100 * number + i) for i in range(rng.randint(1, 15))]
            runs.add(number, pd.DataFrame(new, columns=["__at", "id"]))
            left += new
            number += 1
        until = None if step == 5 else rng.randint(0, 12) + step * 8
        open_runs = len(runs.runs.held)
        pieces = [[tuple(map(int, r)) for r in p[["__at", "id"]].to_numpy()] for p in runs.merged(until)]
        assert all(len(p) <= 4 * open_runs for p in pieces)
        got = [r for p in pieces for r in p]
        want = sorted(r for r in left if until is None or r[0] <= until)
        assert got == want
        left = [r for r in left if r not in set(got)]
        assert runs.earliest == min((at for at, _ in left), default=None)
    assert not left and not runs.slices.held and not runs.runs.held


def test_a_hot_key_comes_in_many_batches(spark, tmp_path):
    rows = [("hot" if i % 3 else f"k{i % 7}", i * 1_000_000, i, i % 5 < 2) for i in range(600)]
    random.Random(2).shuffle(rows)
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _put(spark, rows, src, 0)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        jobs.append_to(state.stream_fold(_stream(spark, src), "key", "ts", "id", _x(), folds.Ema(0.05)), out, ckpt).awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    got = spark.read.parquet(out)
    want = _by_id(sequence.ema(_frame(spark, rows), "key", ["ts", "id"], F.col("bad")), "ema")
    have = _by_id(got, "ema", "late")
    assert have.keys() == want.keys()
    assert all(have[i] == (pytest.approx(want[i][0], abs=1e-12), False) for i in want)
