"""Folds against plain recursion, with keys that span many blocks."""

import random

import pytest
from pyspark.sql import functions as F

from ticketmill.functions import folds
from ticketmill.operators import blocks, sequence

ORDER = ["ts", "event_id"]


def _events(spark, rows):
    schema = "key string, us long, event_id long, bad boolean"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_micros("us"))


def _random_rows(seed, n, gap, hot=0.5, keys=4):
    """A hot key with about half of the rows, and a few others."""
    rng = random.Random(seed)
    at, rows = 0, []
    for i in range(n):
        at += rng.randrange(gap)
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        rows.append((key, at, i, rng.random() < 0.4))
    return rows


def _by_key(rows):
    out = {}
    for key, at, i, bad in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(key, []).append((at, i, bad))
    return out


def _collect(df, *columns):
    return {r["event_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_ema_fixture(spark):
    rows = [("a", 0, 0, True), ("a", 1, 1, True), ("a", 2, 2, False)]
    got = _collect(sequence.ema(_events(spark, rows), "key", ORDER, F.col("bad")), "ema")
    assert [round(got[i][0], 9) for i in range(3)] == [0.05, 0.0975, 0.092625]


@pytest.mark.parametrize("n_blocks", [1, 2, 16])
def test_ema_is_the_recursion(spark, n_blocks):
    rows = _random_rows(1, 3000, 100)
    df = sequence.ema(_events(spark, rows), "key", ORDER, F.col("bad"), blocks=n_blocks)
    got = _collect(df, "ema")
    assert len(got) == len(rows)
    for events in _by_key(rows).values():
        e = 0.0
        for _, i, bad in events:
            e = 0.05 * bad + 0.95 * e
            assert got[i][0] == pytest.approx(e, abs=1e-12)


def test_ema_needs_one_pass_over_a_hot_key(spark):
    df = _events(spark, _random_rows(2, 4000, 50, hot=0.9))
    prepared = df.withColumn("__in_x", F.col("bad").cast("double"))
    frozen = blocks.ordered_blocks(prepared, "key", ORDER, 12)
    assert len(blocks.link_blocks(frozen, "key", folds.Ema(0.05))) >= 8


def test_ema_extreme_alpha(spark):
    rows = _random_rows(3, 1500, 10)
    for alpha in (0.9, 1.0):
        got = _collect(sequence.ema(_events(spark, rows), "key", ORDER, F.col("bad"), alpha), "ema")
        for events in _by_key(rows).values():
            e = 0.0
            for _, i, bad in events:
                e = alpha * bad + (1 - alpha) * e
                assert got[i][0] == pytest.approx(e, abs=1e-9)


def _plain_reset(events, warn, stop):
    e = 0.0
    for _, i, bad in events:
        e = 0.05 * bad + 0.95 * e
        alert = "stop" if e >= stop else "warn" if e >= warn else None
        yield i, e, alert
        if alert == "stop":
            e = 0.0


@pytest.mark.parametrize("n_blocks", [1, 16])
def test_resetting_ema(spark, n_blocks):
    rows = _random_rows(4, 3000, 100)
    df = sequence.ema_with_resets(
        _events(spark, rows), "key", ORDER, F.col("bad"), warn=0.4, stop=0.5, blocks=n_blocks
    )
    got = _collect(df, "ema", "alert")
    seen = set()
    for events in _by_key(rows).values():
        for i, e, alert in _plain_reset(events, 0.4, 0.5):
            assert got[i][0] == pytest.approx(e, abs=1e-9) and got[i][1] == alert
            seen.add(alert)
    assert seen == {None, "warn", "stop"}


@pytest.mark.parametrize("n_blocks", [1, 2, 24])
def test_streaks(spark, n_blocks):
    rows = _random_rows(5, 3000, 100) + [("long", i, 10_000 + i, i != 7) for i in range(2000)]
    df = sequence.failure_streaks(_events(spark, rows), "key", ORDER, F.col("bad"), blocks=n_blocks)
    got = _collect(df, "streak")
    for events in _by_key(rows).values():
        streak = 0
        for _, i, bad in events:
            streak = streak + 1 if bad else 0
            assert got[i] == (streak,)


def test_streaks_link_in_one_round(spark):
    df = _events(spark, [("a", i, i, True) for i in range(4000)]).withColumn("__in_bad", F.col("bad"))
    frozen = blocks.ordered_blocks(df, "key", ORDER, 12)
    starts = blocks.link_blocks(frozen, "key", folds.Streak())
    assert len(starts) >= 8 and max(s[0] for s in starts.values()) > 3000


def test_a_block_is_summarised_batch_by_batch(spark, monkeypatch):
    """No more than one batch of a block is held, so the largest segment is a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        df = _events(spark, [("a", i, i, True) for i in range(3000)]).withColumn("__in_bad", F.col("bad"))
        frozen = blocks.ordered_blocks(df, "key", ORDER, 3)

        class Bounded(folds.Streak):
            def segment(self, columns, state):
                assert len(columns[0]) <= 100
                return super().segment(columns, state)

        assert len(blocks.link_blocks(frozen, "key", Bounded())) == 2
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rate_excess(spark):
    s = 1_000_000
    rows = [("a", at, i, False) for i, at in enumerate((0, 1, s - 1, s, 5 * s))] + [("b", 0, 9, False)]
    got = sequence.rate_excess(_events(spark, rows), "key", "ts", 2).collect()
    assert [(r["key"], r["events"], r["excess"]) for r in got] == [("a", 3, 1)]
    assert got[0]["window_start"] is not None


def test_null_keys_are_a_key(spark):
    rows = [(None, i, i, True) for i in range(40)] + [("a", i, 100 + i, True) for i in range(40)]
    got = _collect(sequence.ema(_events(spark, rows), "key", ORDER, F.col("bad"), blocks=6), "ema")
    assert got[39][0] == pytest.approx(1 - 0.95**40) and got[100][0] == pytest.approx(0.05)


def test_attempts(spark):
    def log(*classes):
        return [(c,) for c in classes]

    cases = {
        "retried": ["rate_limited", "api_error", None],
        "final": ["schema_error", None],
        "spent": ["api_error"] * 5 + [None],
        "single": [None],
    }
    rows = [(k, i, i, c) for k, v in cases.items() for i, c in enumerate(v)]
    df = spark.createDataFrame(rows, "key string, ts long, event_id long, c string")
    got = {
        r["key"]: (r["attempts"], r["status"], r["error_class"], r["waited_seconds"])
        for r in sequence.resolve_attempts(df, "key", ORDER, F.col("c")).collect()
    }
    assert got == {
        "retried": (3, "success", None, 3.0),
        "final": (1, "error", "schema_error", 0.0),
        "spent": (5, "error", "api_error", 15.0),
        "single": (1, "success", None, 0.0),
    }


def test_bad_parameters():
    for wrong in (
        lambda: folds.Ema(0.0),
        lambda: sequence.alert_level(None, 99.0),
    ):
        with pytest.raises(ValueError):
            wrong()


@pytest.mark.parametrize("fold", [folds.Ema(0.3), folds.Streak(), folds.ResettingEma(0.3, 0.5, 0.7), folds.ResettingEma(1.0, 0.5, 0.9), folds.ResettingEma(0.02, 0.1, 0.3)])
def test_charts_take_any_start_through_the_rows(fold):
    rng = random.Random(repr(fold))
    for _ in range(60):
        chance = rng.random()
        rows = [rng.random() < chance for _ in range(rng.randint(1, 200))]
        columns = rows if isinstance(fold, folds.Streak) else [float(x) for x in rows]
        cut = rng.randint(0, len(rows))
        chart = fold.chart()
        for part in (columns[:cut], columns[cut:]):
            chart = fold.extend(chart, [part]) if part else chart
        highest = getattr(fold, "stop", 1.0)
        for start in [0.0, *(rng.random() * highest for _ in range(20))]:
            state = (rng.randint(0, 9),) if isinstance(fold, folds.Streak) else (start,)
            assert fold.through(chart, state)[0] == pytest.approx(fold.segment([columns], state)[1][0], abs=1e-9)


def test_a_reset_chart_stays_small():
    """Starts that are all reset at different rows, then long stretches without and with resets."""
    fold, rng = folds.ResettingEma(0.01, 0.5, 0.9), random.Random(4)
    e, xs = 0.0, []
    for _ in range(30_000):  # an average kept just below the limit, so that ever lower starts reach it
        x = min(1.0, (0.9 - e * 0.99) / 0.01 - 1e-9) if rng.random() < 0.9 else 0.0
        e = 0.01 * x + 0.99 * e
        xs.append(x)
    chart = fold.extend(fold.chart(), [xs])
    assert len(chart[3]) <= 40 / 0.01 and len(chart[5]) <= 40 / 0.01
    for start in (0.0, 0.1, 0.45, 0.8999):
        assert fold.through(chart, (start,))[0] == pytest.approx(fold.segment([xs], (start,))[1][0], abs=1e-6)


def test_resets_are_linked_in_two_passes(spark, monkeypatch):
    """A log in which every block's end depends on its start: the charts are read once, then the blocks are walked."""
    rng = random.Random(6)
    rows = [("hot", i, i, rng.random() < 0.93) for i in range(6000)]
    calls, real = [], blocks._charts
    monkeypatch.setattr(blocks, "_charts", lambda *a: calls.append(len(a[3])) or real(*a))
    df = sequence.ema_with_resets(_events(spark, rows), "key", ORDER, F.col("bad"), alpha=0.001, warn=0.4, stop=0.6, blocks=20)
    got, e = _collect(df, "ema", "alert"), 0.0
    assert len(calls) == 1 and calls[0] >= 15
    for _, _, i, bad in rows:
        e = 0.001 * bad + 0.999 * e
        assert got[i] == (pytest.approx(e, abs=1e-9), "stop" if e >= 0.6 else "warn" if e >= 0.4 else None)
        e = 0.0 if e >= 0.6 else e
    assert {alert for _, alert in got.values()} == {None, "warn", "stop"}


def test_a_task_may_read_several_blocks_and_a_block_several_tasks(spark):
    rows = _random_rows(9, 4000, 100)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("3000", "1g"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = _collect(sequence.failure_streaks(_events(spark, rows), "key", ORDER, F.col("bad"), blocks=13), "streak")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        for events in _by_key(rows).values():
            streak = 0
            for _, i, bad in events:
                streak = streak + 1 if bad else 0
                assert got[i] == (streak,)
