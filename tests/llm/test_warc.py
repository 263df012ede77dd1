"""Archives: an exact round trip, revisits, and the layout of the files."""

import base64
import glob
import hashlib
import struct

from ticketmill.llm import warc

SCHEMA = "page_id long, url string, html string"


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def _round(spark, rows, folder, **options):
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, **options)
    return warc.read_archives(spark, folder).collect()


ROWS = [
    (1, "http://a.example/x y", "<p>été</p>"),
    (2, "http://a.example/2", "<p>été</p>"),
    (3, None, None),
    (4, "http://b.example/", ""),
    (5, "u\r\nWARC-Type: fake", "line\r\n\r\nWARC/1.1\r\n"),
    (5, "u\r\nWARC-Type: fake", "line\r\n\r\nWARC/1.1\r\n"),
    (None, "http://c.example/", "<p>été</p>"),
    (6, "http://d.example/", "big " * 100_000),
] + [(100 + i, f"http://h.example/{i}", "hot") for i in range(300)]


def test_round_trip(spark, tmp_path):
    got = _round(spark, ROWS, str(tmp_path / "w"))
    assert len(got) == len(ROWS)
    assert sorted(r.payload_digest for r in got) == sorted(_digest(h) for *_, h in ROWS)
    by_id = {}
    for r in got:
        by_id.setdefault(r.record_id, []).append(r)
    html = {str(i): h or "" for i, _, h in ROWS if i is not None} | {"-": "<p>été</p>"}
    for key, records in by_id.items():
        for r in records:
            assert r.payload_digest == _digest(html[key]) and r.payload_bytes == len(html[key].encode())
            assert (r.kind == "response") == (r.payload is not None)
            if r.kind == "response":
                assert bytes(r.payload) == html[key].encode() and r.refers_to is None
    assert by_id["2"][0].kind == "response" and by_id["1"][0].refers_to == by_id["-"][0].refers_to == "2"
    assert by_id["4"][0].kind == "response" and by_id["3"][0].refers_to == "4"
    assert sorted(r.kind for r in by_id["5"]) == ["response", "revisit"]
    hot = [by_id[str(100 + i)][0] for i in range(300)]
    assert hot[-1].kind == "response" and {r.refers_to for r in hot[:-1]} == {"399"}


def test_small_payloads_are_never_revisits(spark, tmp_path):
    got = _round(spark, ROWS, str(tmp_path / "w"), min_bytes=10)
    kinds = {r.record_id: r.kind for r in got}
    assert kinds["3"] == kinds["4"] == kinds["100"] == "response" and kinds["1"] == "revisit"


def test_files_are_frames_with_their_dictionary_first(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rows = [(i, "http://x.example/", f"<html><body>page {i} " + "word " * 50) for i in range(400)]
    assert len(_round(spark, rows, str(tmp_path / "w"))) == 400
    files = glob.glob(str(tmp_path / "w" / "part-*"))
    assert len(files) > 10
    for name in files:
        data = open(name, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC
        assert data[8 + size : 16 + size] == warc.EMPTY_FRAME.encode()
        assert data.endswith(warc.EMPTY_FRAME.encode())


def test_empty(spark, tmp_path):
    assert _round(spark, [], str(tmp_path / "w")) == []
