"""Sources and sinks on files written to a temporary folder."""

import bz2
import gzip
import json
import lzma

import pytest
from pyspark.sql import functions as F

from ticketmill.functions.fields import TICKET_FIELDS
from ticketmill.functions.detectors import EMAIL
from ticketmill.operators import gates, records, redaction, routing
from ticketmill.sources import files

TEXT = '{"a":1}\r\n\n{"a":"é"}\n{bad\n{"a":2}'


def _write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_tolerant_scan(spark, tmp_path):
    _write(tmp_path / "in.jsonl", TEXT)
    lines = files.read_lines(spark, str(tmp_path / "in.jsonl"))
    judged = records.with_verdict(lines)
    good = records.accepted(judged).select("json.line")
    assert [r["line"] for r in good.collect()] == ['{"a": 1}', '{"a": "é"}', '{"a": 2}']
    rejected = records.rejects(judged, ["value"]).collect()
    assert [r["value"] for r in rejected] == ["{bad"] and rejected[0]["reason"].startswith("Invalid JSON")
    with pytest.raises(ValueError):
        files.read_lines(spark, "x.xz")


def test_compressed_files(spark, tmp_path):
    data = TEXT.encode()
    for name, content in {
        "plain.jsonl": data,
        "a.jsonl.gz": gzip.compress(data),
        "b.jsonl.bz2": bz2.compress(data),
        "sub/c.jsonl.xz": lzma.compress(data),
        "sub/d.JSONL.GZ": gzip.compress(data),
        "e.jsonl.XZ": lzma.compress(data),
    }.items():
        _write(tmp_path / name, content)
    counted = files.read_compressed(spark, str(tmp_path)).groupBy("file").agg(
        F.count("*").alias("n"), F.count_if(F.col("value").contains("é")).alias("accents")
    )
    rows = counted.collect()
    assert len(rows) == 6 and all((r["n"], r["accents"]) == (5, 1) for r in rows), rows


def test_integrity(spark, tmp_path):
    many = "\n".join(['{"a":1}'] * 5000 + ["{bad"] + ['{"a":1}'] * 5000 + ["{worse"])
    _write(tmp_path / "long.jsonl", many)
    _write(tmp_path / "good.jsonl", '{"a":1}\n\n{"a":2}\n')
    _write(tmp_path / "bad.jsonl", '\n{"a":1}\n{')
    _write(tmp_path / "empty.jsonl", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = files.file_integrity(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r["file"].rsplit("/", 1)[1]: (r["is_valid"], r["first_bad_line"]) for r in rows}
    assert got == {
        "long.jsonl": (False, 5001),
        "good.jsonl": (True, None),
        "bad.jsonl": (False, 3),
        "empty.jsonl": (True, None),
    }


def test_export(spark, tmp_path):
    _write(
        tmp_path / "export.csv",
        "Number,Short Description,Description,Category,Close Notes,Category,Subcategory\n"
        '1," a ","two\nlines",first,N/A,second,\n'
        "2,   ,, x\t,done,other,00123\n",
    )
    rows = files.read_export(spark, str(tmp_path / "export.csv"))
    assert tuple(rows.columns) == TICKET_FIELDS
    got = {r["Category"]: tuple(r) for r in rows.collect()}
    assert got["first"] == ("a", "two\nlines", None, "first", None, None)
    assert got["x"] == (None, None, "done", "x", "00123", None)


def test_workbooks_need_a_reader(spark, tmp_path):
    with pytest.raises(RuntimeError):
        files.read_workbooks(spark, str(tmp_path))


TREE = {
    "a.py": "print('a')\n",
    "pkg/b.py": "b = 1",
    "pkg/c.txt": "no",
    "pkg/with space+plus.py": "c = 2",
    "venv/x.py": "no",
    ".git/y.py": "no",
    "pkg/__pycache__/z.py": "no",
}


def test_discovery_and_packing(spark, tmp_path):
    root = tmp_path / "venv"  # the root's own name does not count
    for name, text in TREE.items():
        _write(root / name, text)
    found = files.discover_files(spark, str(root))
    assert sorted(r["path"] for r in found.collect()) == ["a.py", "pkg/b.py", "pkg/with space+plus.py"]

    routing.write_packed(found, str(tmp_path / "packed"), shards=3)
    parts = sorted((tmp_path / "packed").glob("part-*"))
    packed = "".join(p.read_text() for p in parts)
    assert packed == routing.PACK_TITLE + routing.PACK_INTRO + "".join(
        f"## File: {n}\n\n```python\n{TREE[n]}\n```\n\n" for n in ["a.py", "pkg/b.py", "pkg/with space+plus.py"]
    )


def test_encodings(spark, tmp_path):
    _write(tmp_path / "utf8.txt", "é ü" * 3)
    _write(tmp_path / "latin.txt", "é ü".encode("cp1252"))
    _write(tmp_path / "wide.txt", "é ü".encode("utf-16"))
    _write(tmp_path / "odd.txt", b"\x81\x8d")
    rows = files.file_encoding_report(spark, str(tmp_path)).collect()
    got = {r["path"].rsplit("/", 1)[1]: (r["encoding"], r["valid_utf8"]) for r in rows}
    assert got == {
        "utf8.txt": ("utf-8", True),
        "latin.txt": ("cp1252", False),
        "wide.txt": ("utf-16", False),
        "odd.txt": ("latin-1", False),
    }


def _lines(folder):
    return [line for p in sorted(folder.glob("part-*")) for line in p.read_text().splitlines()]


def test_jsonl_writer_modes(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    out = tmp_path / "out"
    routing.write_jsonl(df, str(out))
    assert _lines(out) == ['{"a":"é","b":null}']
    with pytest.raises(Exception, match="already exists"):
        routing.write_jsonl(df, str(out))
    routing.write_jsonl(df, str(out), mode="overwrite")
    routing.write_jsonl(df.limit(0), str(out), mode="append")
    assert _lines(out) == ['{"a":"é","b":null}']


def test_routed_sinks(spark, tmp_path):
    good = {"instruction": "a b c d e", "response": "a b c d e", "category": "", "subcategory": "", "assignment_group": ""}
    rows = [
        ("{}", json.dumps({"status": "good", "data": good})),
        ("{}", json.dumps({"status": "bad", "data": "why"})),
        ("{", None),
        ("{}", None),
    ]
    routed = gates.classify(gates.raw_tickets(spark.createDataFrame(rows, "value string, response string")))
    routing.write_routed(routed, str(tmp_path / "run"))
    assert [json.loads(x) for x in _lines(tmp_path / "run/good")] == [good]
    bad = [json.loads(x) for x in _lines(tmp_path / "run/bad")]
    assert {b["error_class"] for b in bad} == {"model_bad", "invalid_json", "refusal"} and len(bad) == 3
    # Every answer that came back is a transaction, good or bad.
    assert len(_lines(tmp_path / "run/transactions")) == 2
    wrapped = routing.wrap_errors(routing.bad_rows(routed), "error").columns
    assert wrapped == ["error"]


def test_quarantine_sink(spark, tmp_path):
    _write(tmp_path / "in.jsonl", TEXT + "\n[1]\n")
    judged = records.with_verdict(files.read_lines(spark, str(tmp_path / "in.jsonl")))
    out = records.rejects(judged, ["file", "value"], objects_only=True).collect()
    assert [(r["value"], r["reason"].split(":")[0]) for r in out] == [("{bad", "Invalid JSON"), ("[1]", "not an object")]


def test_broken_utf8_is_rejected_not_fatal(spark, tmp_path):
    _write(tmp_path / "in.jsonl", b'{"a":"\xff a@b.co"}\n{"a":1}\n\xff\xfe\n\n')
    lines = files.read_lines(spark, str(tmp_path / "in.jsonl"))
    judged = records.with_verdict(lines)
    verdicts = sorted(r[0] for r in judged.select("json.verdict").collect())
    assert verdicts == ["blank", "invalid_unicode", "invalid_unicode", "ok"]
    for backend in ("native", "arrow"):
        out = redaction.redact_columns(lines, ["value"], [EMAIL], backend=backend).select(F.make_valid_utf8("value"))
        assert [r[0] for r in out.collect()][0] == '{"a":"\ufffd <EMAIL_ADDRESS>"}'
    assert redaction.redact_json_lines(lines).filter("value IS NOT NULL").count() == 1
    row = files.file_integrity(spark, str(tmp_path / "in.jsonl")).first()
    assert (row["is_valid"], row["first_bad_line"]) == (False, 1)


def test_unknown_white_space_around_a_value(spark):
    df = spark.createDataFrame([("\u00a0{}",)], "value string")
    for strip_line, verdict in ((True, "ok"), (False, "invalid")):
        judged = records.with_verdict(df, strip_line=strip_line)
        assert judged.select("json.verdict").first()[0] == verdict


def test_a_compressed_file_in_a_folder_is_never_read_as_lines(spark, tmp_path):
    _write(tmp_path / "a.jsonl", '{"a":1}\n')
    _write(tmp_path / "b.jsonl.xz", lzma.compress(b'{"a":2}\n'))
    with pytest.raises(Exception, match="read_compressed"):
        files.read_lines(spark, str(tmp_path)).count()
    assert sorted(r["value"] for r in files.read_compressed(spark, str(tmp_path)).collect()) == ['{"a":1}', '{"a":2}']


def test_compressed_lines_get_the_verdict_of_plain_ones(spark, tmp_path):
    data = b'{"a":"\xff"}\n{"a":1}\r\n\n{"b":2}'
    _write(tmp_path / "plain/a.jsonl", data)
    _write(tmp_path / "packed/a.jsonl.xz", lzma.compress(data))
    verdicts = [
        sorted(r[0] for r in records.with_verdict(files.read_compressed(spark, str(tmp_path / d))).select("json.verdict").collect())
        for d in ("plain", "packed")
    ]
    assert verdicts[0] == verdicts[1] == ["blank", "invalid_unicode", "ok", "ok"]


def test_plain_files_are_not_opened_as_blobs(spark, tmp_path):
    _write(tmp_path / "a.jsonl", '{"a":1}\n' * 2000)
    _write(tmp_path / "b.jsonl.xz", lzma.compress(b'{"a":2}\n'))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        assert files.read_compressed(spark, str(tmp_path)).count() == 2001
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_exports_with_columns_in_other_orders(spark, tmp_path):
    from ticketmill.functions.fields import EXPORT_COLUMNS

    short, long = EXPORT_COLUMNS["Short_Description"], EXPORT_COLUMNS["Description"]
    _write(tmp_path / "e/a.csv", f"{short},{long}\ns1,d1\n")
    _write(tmp_path / "e/b.csv", f"{long},{short},Other\nd2,s2,x\nd3,s3,y\n")
    _write(tmp_path / "e/c.csv", f"{short},{long}\ns4,d4\n")
    rows = files.read_export(spark, str(tmp_path / "e")).collect()
    got = sorted((r["Short_Description"], r["Description"], r["Category"]) for r in rows)
    assert got == [("s1", "d1", None), ("s2", "d2", None), ("s3", "d3", None), ("s4", "d4", None)]


def test_lines_in_their_own_encoding(spark, tmp_path):
    _write(tmp_path / "a.txt", "naïve\n".encode())
    _write(tmp_path / "b.txt", "café €\n".encode("cp1252"))
    got = sorted(r["value"] for r in files.decoded_lines(spark, str(tmp_path)).collect())
    assert got == ["café €", "naïve"]


def test_discovery_does_not_move_contents(spark, tmp_path):
    _write(tmp_path / "a.py", "x = 1\n")
    _write(tmp_path / "b.py", "")
    found = files.discover_files(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == [("a.py", "x = 1\n"), ("b.py", "")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert all("content" not in line for line in plan.splitlines() if "Exchange" in line)


def test_large_files_come_in_pieces(spark, tmp_path):
    """Cut at characters wherever a piece ends, in bytes that are no UTF-8 too; no row holds much more than a piece."""
    contents = {
        "plain": "aé€😀\n".encode() * 7,
        "empty": b"",
        "short": "😀".encode(),
        "broken": b"\x80\x80\x80\x80\x80\xe2\x82a\xf0\x9f\x98\xff\x80\xe2\x82",
    }
    for name, data in contents.items():
        (tmp_path / f"{name}.py").write_bytes(data)
    whole = {r["path"]: r["content"] for r in files.discover_files(spark, str(tmp_path)).collect()}
    assert whole == {f"{n}.py": d.decode("utf-8", "replace") for n, d in contents.items()}
    for piece in (1, 3, 5, 1000):
        rows = files.discover_files(spark, str(tmp_path), piece=piece).orderBy("path", "begin").collect()
        joined = {}
        for r in rows:
            joined[r["path"]] = joined.get(r["path"], "") + r["content"]
        assert joined == whole and max(len(r["content"]) for r in rows) <= piece + 3
