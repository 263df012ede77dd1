"""The counted writer: counts against what lies in the folder, skipped records, repeated and failed tasks."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import counted


def _lines(folder):
    return [line for p in sorted(folder.glob("part-*")) for line in p.read_text().splitlines()]


def test_counts_are_those_of_the_files(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).alias("x"), F.lit("é").alias("t")).repartition(5)
    got = counted.write_counted(df, str(tmp_path / "out"), bufferBytes="1000").first()
    lines = _lines(tmp_path / "out")
    assert sorted(json.loads(line)["id"] for line in lines) == [i for i in range(1000) if i % 10]
    size = sum(p.stat().st_size for p in (tmp_path / "out").glob("part-*"))
    assert (got.records, got.skipped, got.bytes) == (900, 100, size) and got.operations >= size // 1200
    assert got.seconds > 0 and got.records_per_second == pytest.approx(900 / got.seconds)
    assert not list((tmp_path / "out").glob("_staging*"))


def test_overwrite_and_append(spark, tmp_path):
    out = str(tmp_path / "out")
    counted.write_counted(spark.range(3), out)
    assert counted.write_counted(spark.range(4), out).first().records == 4
    assert len(_lines(tmp_path / "out")) == 7
    assert counted.write_counted(spark.range(2), out, mode="overwrite").first().records == 2
    assert sorted(_lines(tmp_path / "out")) == ['{"id":0}', '{"id":1}']
    nothing = counted.write_counted(spark.range(0), str(tmp_path / "none")).first()
    assert (nothing.records, nothing.bytes, nothing.operations, nothing.skipped) == (0, 0, 0, 0)


def test_a_failed_job_leaves_nothing_in_place(spark, tmp_path):
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        counted.write_counted(bad, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())


def test_a_task_that_ran_twice_counts_once(tmp_path):
    """Only the message of the attempt that counts reaches the commit; the other's file goes with the staging folder."""
    writer = counted._Writer({"path": str(tmp_path / "out")}, False)
    staging = tmp_path / "out" / writer.staging.rsplit("/", 1)[1]
    staging.mkdir(parents=True)
    for attempt in (1, 2):
        (staging / f"part-00000-{attempt}.jsonl").write_text("{}\n")
    writer.commit([counted.Written("part-00000-2.jsonl", 1, 3, 1, 0, 0.5), counted.Written(None, skipped=2)])
    assert [p.name for p in (tmp_path / "out").glob("part-*")] == ["part-00000-2.jsonl"]
    sums = json.loads((tmp_path / "out/_metrics.json").read_text())
    assert sums == {"records": 1, "bytes": 3, "operations": 1, "skipped": 2, "seconds": 0.5} and not staging.exists()


def test_lines():
    record = {"a": None, "d": dt.date(2024, 1, 2), "n": decimal.Decimal("3"), "m": decimal.Decimal("3.5"), "l": [{"x": "é"}]}
    assert counted.json_line(record).decode() == '{"a":null,"d":"2024-01-02","n":3,"m":3.5,"l":[{"x":"é"}]}\n'
    for odd in (float("inf"), b"x", "\ud800"):
        assert counted.json_line({"a": odd}) is None
