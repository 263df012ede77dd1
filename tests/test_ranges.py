"""Listing in tasks, reading by ranges, and the bounded stream over files larger than a trigger."""

import lzma
import os
import random
import shutil
import subprocess

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketmill.sources import bounded, encodings, ranges, xz


def _write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_folders_are_listed_level_by_level(spark, tmp_path):
    for name in ("a.py", "b.txt", "x/__init__.py", "x/y/z/deep file+ü%.py", ".hidden/c.py", "venv/no.py", "x/venv/no.py"):
        _write(tmp_path / name, name)
    _write(tmp_path / "x" / "empty.py", "")
    os.makedirs(tmp_path / "nothing")
    found = ranges.list_files(spark, str(tmp_path), "*.py", ignored=["venv"]).collect()
    prefix = f"file:{tmp_path}/"
    sizes = {r.file.removeprefix(prefix): r.size for r in found}
    kept = ["a.py", "x/__init__.py", "x/y/z/deep file+ü%.py", ".hidden/c.py"]
    assert sizes == {k: len(k.encode()) for k in kept} | {"x/empty.py": 0}
    (one,) = ranges.list_files(spark, str(tmp_path / "b.txt")).collect()
    assert one.file == prefix + "b.txt" and one.modified is not None
    assert ranges.list_files(spark, str(tmp_path / "nothing")).collect() == []


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16-le"])
def test_each_line_belongs_to_one_range(encoding):
    rng = random.Random(1)
    for _ in range(400):
        lines = ["".join(rng.choice("abਊĊ") for _ in range(rng.choice([0, 0, 1, 3, 9]))) for _ in range(rng.randint(0, 9))]
        data, newline = "\n".join(lines).encode(encoding), "\n".encode(encoding)
        want = [line.encode(encoding) for line in lines]
        step = rng.choice([2, 4, 6, 10, 100])
        got = [
            line
            for at in range(0, len(data), step)
            for line in ranges.lines_between(pa.BufferReader(data), len(data), at, min(at + step, len(data)), newline)
        ]
        assert got == (want[:-1] if want and not want[-1] else want)


def test_chunks_cut_files_at_lines(spark, tmp_path):
    texts = {"a": "1\n22\n\n4\n5\n", "b": "x", "c": "", "d": "1\n2", "e": "\n" * 7, "f": "long" * 100 + "\n1"}
    for name, text in texts.items():
        _write(tmp_path / "in" / name, text)
    found = bounded.chunks(ranges.list_files(spark, str(tmp_path / "in")), every=2, range_bytes=3).collect()
    for name, text in texts.items():
        mine = sorted((r.byte, r.end) for r in found if r.file.endswith("/" + name))
        lines = text.splitlines(keepends=True)
        assert [text[a:b] for a, b in mine] == ["".join(lines[i : i + 2]) for i in range(0, len(lines), 2)]


def _start(spark, tmp_path, mark=None):
    checkpoint = str(tmp_path / "checkpoint")
    lines = bounded.stream_bounded(spark, str(tmp_path / "index"), checkpoint, rangeBytes="20000")

    def write(batch, number):
        if mark is not None and number == mark:
            raise RuntimeError("lost")
        batch.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={number}"))

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def _counts(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "out")).groupBy("batch").count().orderBy("batch").collect()
    return [r["count"] for r in rows]


def test_a_large_file_is_several_triggers(spark, tmp_path):
    """300,000 lines of one file in triggers of 40,000; a failure in the middle and a later file lose and repeat nothing."""
    _write(tmp_path / "in" / "one.jsonl", "".join(f'{{"n": {i}}}\r\n' for i in range(299_999)) + '{"n": 299999}')
    assert bounded.index_lines(spark, str(tmp_path / "in"), str(tmp_path / "index"), every=40_000) == 8
    query = _start(spark, tmp_path, mark=3)
    with pytest.raises(Exception, match="lost"):
        bounded.finish(query)
    assert _counts(spark, tmp_path) == [40_000] * 3
    bounded.finish(_start(spark, tmp_path))
    assert _counts(spark, tmp_path) == [40_000] * 7 + [20_000]
    _write(tmp_path / "in" / "two.jsonl", '{"n": 300000}\n')
    assert bounded.index_lines(spark, str(tmp_path / "in"), str(tmp_path / "index"), every=40_000) == 1
    assert bounded.index_lines(spark, str(tmp_path / "in"), str(tmp_path / "index"), every=40_000) == 0
    bounded.finish(_start(spark, tmp_path))
    assert _counts(spark, tmp_path) == [40_000] * 7 + [20_000, 1]
    numbers = spark.read.parquet(str(tmp_path / "out")).select(F.get_json_object("value", "$.n").cast("long").alias("n"))
    got = numbers.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(got) == (300_001, 300_001, 0, 300_000)


def test_lanes_share_an_index(spark, tmp_path):
    """Several streams at once hold each chunk once, go on where they stopped, and are not mixed up."""
    index, run = str(tmp_path / "index"), str(tmp_path / "run")
    _write(tmp_path / "in" / "one", "".join(f"{i}\n" for i in range(25)))
    assert bounded.index_lines(spark, str(tmp_path / "in"), index, every=4) == 7

    def start():
        def started(lines, lane, checkpoint):
            def write(batch, number):
                batch.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "out" / f"lane={lane}" / f"batch={number}"))

            return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()

        return [started(lines, i, checkpoint) for i, (lines, checkpoint) in enumerate(bounded.stream_lanes(spark, index, run, 3))]

    queries = start()
    assert len(queries) == 3 and all(q.isActive for q in queries)
    bounded.finish(*queries)
    _write(tmp_path / "in" / "two", "25\n26\n")
    assert bounded.index_lines(spark, str(tmp_path / "in"), index, every=4) == 1
    bounded.finish(*start())
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(int(r["value"]) for r in rows.collect()) == list(range(27))
    sizes = sorted((r["lane"], r["batch"], r["count"]) for r in rows.groupBy("lane", "batch").count().collect())
    assert [n for *_, n in sizes] == [4, 4, 1, 2, 4, 4, 4, 4]
    with pytest.raises(ValueError, match="lane 1 of 3"):
        bounded._Reader({"index": index, "checkpoint": f"{run}/lane-1", "lane": "1", "lanes": "2"}).latestOffset()


def _through(ends, parts):
    state = 0
    for part in parts:
        state = ends(part)[state]
    return state


def test_utf8_is_judged_from_any_state():
    rng = random.Random(2)
    good = [b"a", "é".encode(), "日".encode(), "🎉".encode(), "퟿".encode()]
    odd = [b"\x80", b"\xff", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xc0\x80", b"\xe0\x80\x80"]
    for _ in range(2000):
        data = b"".join(rng.choice(good + odd * (rng.random() < 0.15)) for _ in range(rng.randint(0, 12)))
        data = data[: rng.randint(0, len(data))] if rng.random() < 0.3 else data
        size, read = rng.randint(1, 7), rng.randint(1, 3)
        parts = [data[i : i + size] for i in range(0, len(data), size)]
        for part in parts:
            ends = encodings.utf8_ends(part[i : i + read] for i in range(0, len(part), read))
            for state, end in enumerate(ends):
                for byte in part:
                    state = encodings.step(state, byte)
                assert state == end
        valid = data.decode("utf-8", "replace").encode() == data and b"\xef\xbf\xbd" not in data
        assert (_through(lambda p: encodings.utf8_ends([p]), parts) == encodings.DONE) == valid


@pytest.mark.parametrize("little", [True, False])
def test_utf16_pairs_may_lie_on_a_border(little):
    rng = random.Random(3)
    for _ in range(500):
        units = [rng.choice([0x41, 0xD83C, 0xDF89, 0xFEFF, 0x0A]) for _ in range(rng.randint(0, 8))]
        data = b"".join(u.to_bytes(2, "little" if little else "big") for u in units) + b"x" * (rng.random() < 0.1)
        size = rng.choice([2, 4, 6])
        parts = [data[i : i + size] for i in range(0, len(data), size)]
        try:
            valid = data.decode("utf-16-le" if little else "utf-16-be") is not None
        except UnicodeDecodeError:
            valid = False
        assert (_through(lambda p: encodings.utf16_ends(iter([p]), little), parts) == encodings.WHOLE) == valid


def test_large_files_are_judged_and_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(4)
    lines = ["".join(rng.choice("aé日🎉 ") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    text = "\r\n".join(lines)
    plain = ["naïve €"] * 50
    for name, data in {
        "utf8": text.encode(),
        "little": b"\xff\xfe" + text.encode("utf-16-le"),
        "big": b"\xfe\xff" + text.encode("utf-16-be"),
        "torn": b"\xff\xfe" + text.encode("utf-16-le") + b"\x00\xd8",
        "western": "\n".join(plain).encode("cp1252"),
        "cut": text.encode()[:-1] + b"\xf0\x9f",
        "empty": b"",
        "old": b"\x81\n\x8d",
    }.items():
        _write(tmp_path / name, data)
    listed = ranges.list_files(spark, str(tmp_path))
    report = {r.file.rsplit("/", 1)[1]: (r.encoding, r.valid_utf8) for r in encodings.file_encodings(listed, range_bytes=37).collect()}
    assert report == {
        **{name: ("utf-8", True) for name in ("utf8", "empty")},
        **{name: ("utf-16", False) for name in ("little", "big")},
        "old": ("latin-1", False),
        **{name: ("cp1252", False) for name in ("western", "torn", "cut")},
    }
    read = encodings.lines_in_encodings(listed, range_bytes=38)
    got = {}
    for r in read.collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.value)
    for name in ("utf8", "little", "big"):
        assert sorted(got[name]) == sorted(lines if lines[-1] else lines[:-1])
    assert got["western"] == plain and sorted(got["old"]) == ["\x81", "\x8d"] and "empty" not in got


def _blocks_of(text, size):
    """An .xz file with a block for each part: streams one after the other, padded."""
    parts = [text[i : i + size] for i in range(0, len(text), size)]
    return b"".join(lzma.compress(p, preset=0) + b"\0" * (4 * (i % 3)) for i, p in enumerate(parts))


def test_xz_files_are_read_by_block(spark, tmp_path):
    rng = random.Random(5)
    text = b"\n".join(b"x" * rng.choice([0, 1, 5, 40, 200]) + b"%d" % i for i in range(900))
    for name, data in {"many.xz": _blocks_of(text, 700), "lines.xz": _blocks_of(b"ab\ncd\n" * 50, 6), "one.xz": lzma.compress(b"a\n\nb"), "none.xz": lzma.compress(b""), "long.xz": _blocks_of(b"y" * 5000 + b"\nz", 64)}.items():
        _write(tmp_path / name, data)
    with open(tmp_path / "many.xz", "rb") as source:
        listed = xz.blocks(pa.PythonFile(source), os.path.getsize(tmp_path / "many.xz"))
    assert len(listed) == -(-len(text) // 700)
    read = xz.read_xz(ranges.list_files(spark, str(tmp_path)), tasks=40)
    got = {}
    for r in read.withColumn("task", F.spark_partition_id()).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((bytes(r.value), r.task))
    assert sorted(v for v, _ in got["many.xz"]) == sorted(text.split(b"\n")) and len({t for _, t in got["many.xz"]}) > 20
    assert sorted(v for v, _ in got["lines.xz"]) == [b"ab"] * 50 + [b"cd"] * 50
    assert [v for v, _ in got["one.xz"]] == [b"a", b"", b"b"] and "none.xz" not in got
    assert sorted(v for v, _ in got["long.xz"]) == [b"y" * 5000, b"z"]


@pytest.mark.skipif(shutil.which("xz") is None, reason="needs the xz tool")
def test_blocks_of_one_stream(tmp_path):
    text = b"".join(b"line %d\n" % i for i in range(20_000))
    _write(tmp_path / "a", text)
    subprocess.run(["xz", "--block-size=20000", "--check=sha256", str(tmp_path / "a")], check=True)
    size = os.path.getsize(tmp_path / "a.xz")
    with open(tmp_path / "a.xz", "rb") as raw:
        source = pa.PythonFile(raw)
        listed = xz.blocks(source, size)
        got = [line for i in range(len(listed)) for line in xz.block_lines(source, listed, i)]
    assert len(listed) == -(-len(text) // 20_000) and got == text.splitlines()
