"""Monitoring aggregates on hand-made rows, and the shape of their plans."""

from pyspark.sql import functions as F

from ticketmill.operators import monitor


def _bad_rows(spark, n, classes=None):
    rows = [("a", i, i, True, f"raw{i}", (classes or ["too_short"] * n)[i]) for i in range(n)]
    rows += [("quiet", i, 100 + i, False, "r", None) for i in range(3)]
    return spark.createDataFrame(rows, "key string, ts long, id long, bad boolean, raw string, cls string")


def _recent(df):
    return monitor.recent_bad(df, F.col("bad"), "key", ["ts", "id"])


def test_run_summary_of_nothing(spark):
    df = spark.createDataFrame([], "bad boolean")
    assert monitor.run_summary(df, F.col("bad")).first().asDict() == {
        "total": 0, "good": 0, "bad": 0, "error_rate": 0.0,
    }


def test_recent_and_digest(spark):
    recent = _recent(_bad_rows(spark, 25))
    assert recent.count() == 20
    row = monitor.digest(recent, "key", F.col("raw"), F.col("cls")).first()
    want = monitor.DIGEST_HEAD
    for n, i in enumerate(range(20, 25), start=1):
        want += f"\nTicket {n}:\nRaw data:\nraw{i}\nError reason:\ntoo_short\n"
    assert row["samples"] == 5 and row["digest"] == want + monitor.DIGEST_TAIL


def test_health(spark):
    def decide(classes):
        df = _bad_rows(spark, len(classes), classes)
        rows = monitor.health(df, _recent(df), "key", F.col("cls")).collect()
        return {r["key"]: r["decision"] for r in rows}

    assert decide(["too_short"] * 5) == {"a": "continue", "quiet": "stop"}
    assert decide(["timeout"] * 9 + ["too_short"] * 5)["a"] == "continue"
    assert decide(["api_error", "timeout", "unexpected", "too_short", "no_data"])["a"] == "stop"


def test_redaction_metrics_ignore_empty_texts(spark):
    df = spark.createDataFrame([("ab",), ("ab",), ("c",), ("",), (None,)], "t string")
    row = monitor.redaction_metrics(df, F.col("t"), F.col("t") == "c").first()
    assert (row["texts"], row["chars"], row["errors"], row["distinct_texts"]) == (3, 5, 1, 2)
    assert row["memo_hit_ratio"] == 1 / 3
    empty = monitor.redaction_metrics(df.limit(0), F.col("t")).first()
    assert (empty["texts"], empty["error_rate"], empty["memo_hit_ratio"]) == (0, 0.0, 0.0)


def test_throughput_without_elapsed_time(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("b", 15)], "key string, s long").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    rows = {r["key"]: r["records_per_second"] for r in monitor.throughput(df, "ts", ["key"]).collect()}
    assert rows == {"a": 0.0, "b": 0.2}


def test_running_totals_cross_days(spark):
    starts = [(i * 50_000, i % 3, i % 2) for i in range(1, 12)]
    df = spark.createDataFrame(starts, "s long, good long, bad long").select(
        F.timestamp_seconds("s").alias("window_start"), (F.col("good") + F.col("bad")).alias("processed"), "good", "bad"
    )
    rows = monitor.with_totals(df).orderBy("window_start").collect()
    total = 0
    for row, (_, good, bad) in zip(rows, starts):
        total += good + bad
        assert row["processed_so_far"] == total


def test_rankings_limit_rows_before_the_shuffle(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    plan = monitor.recent_bad(events, F.expr("event_type = 'error'"), "user_id", ["ts", "event_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_unreadable_answers_mean_stop(spark):
    answers = ['{"decision":"CONTINUE"}', '{"decision":"continue"} x', '{"decision":["continue"]}', "", None, '{"decision":null}']
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "id int, a string")
    got = {r["id"]: r["d"] for r in df.select("id", monitor.decision_of(F.col("a")).alias("d")).collect()}
    assert [got[i] for i in range(6)] == ["continue"] + ["stop"] * 5
