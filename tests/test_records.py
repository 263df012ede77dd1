"""Line verdicts, fields and gates on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from ticketmill.functions import fields
from ticketmill.functions.jsonl import json_verdict
from ticketmill.functions.text import WHITE_SPACE, strip, word_count
from ticketmill.operators import gates, records, sequence
from ticketmill.settings import Settings

LINES = [
    ('{"a":1}', "ok", "object", '{"a": 1}'),
    ("", "blank", None, None),
    (" \t \x1c", "blank", None, None),
    ('{"a":1} x', "invalid", None, None),
    ('{"a":1,}', "invalid", None, None),
    ("{'a':1}", "invalid", None, None),
    ('{"a":1,"a":2}', "ok", "object", '{"a": 2}'),
    ('{"b":1,"a":2}', "ok", "object", '{"b": 1, "a": 2}'),
    ('{"a":1.0}', "ok", "object", '{"a": 1.0}'),
    ('{"a":NaN}', "ok", "object", '{"a": NaN}'),
    ("[1,2]", "ok", "array", "[1, 2]"),
    ("5", "ok", "number", "5"),
    ('"s"', "ok", "string", '"s"'),
    ("true", "ok", "boolean", "true"),
    ("null", "ok", "null", "null"),
    ('﻿{"a":1}', "invalid", None, None),
    ('{"a":"x\ty"}', "invalid", None, None),
    ("01", "invalid", None, None),
    ('{"a":"\\ud800"}', "invalid_unicode", None, None),
    ('{"a":"\\u00e9"}', "ok", "object", '{"a": "é"}'),
    ("[" * 100_000, "invalid", None, None),
    ('{"a":' + "9" * 5000 + "}", "invalid", None, None),
    (None, "blank", None, None),
]


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(LINES)], "id int, value string")
    return records.with_verdict(df)


def test_verdicts(judged):
    got = {r["id"]: r["json"] for r in judged.collect()}
    for i, (_, verdict, kind, line) in enumerate(LINES):
        assert (got[i]["verdict"], got[i]["kind"], got[i]["line"]) == (verdict, kind, line), LINES[i]


def test_nan_can_be_refused(spark):
    df = spark.createDataFrame([('{"a":NaN}',), ('{"a":1e5}',)], "v string")
    out = [r[0] for r in df.select(json_verdict(F.col("v"), allow_nan=False)["verdict"]).collect()]
    assert out == ["invalid", "ok"]


def test_counts(judged):
    ok = sum(x[1] == "ok" for x in LINES)
    blank = sum(x[1] == "blank" for x in LINES)
    report = records.reformat_report(judged).first()
    assert report.asDict() == {"total_lines": len(LINES), "valid_lines": ok, "invalid_lines": len(LINES) - ok}
    counted = records.count_records(judged).first()
    assert (counted["valid_records"], counted["invalid_records"]) == (ok, len(LINES) - ok - blank)


def test_reformat_observes_in_the_same_pass(spark):
    df = spark.createDataFrame([('{"a":1}',), ("",), ("{",)], "value string")
    seen = Observation("reformat")
    assert [r[0] for r in records.reformat(df, observation=seen).collect()] == ['{"a": 1}']
    assert seen.get == {"total_lines": 3, "valid_lines": 1, "invalid_lines": 2}


def test_rejects_and_objects(judged):
    kept = records.objects(judged).count()
    assert kept == sum(x[2] == "object" for x in LINES)
    rejected = records.rejects(judged, ["id"], objects_only=True)
    assert kept + rejected.count() + sum(x[1] == "blank" for x in LINES) == len(LINES)


def test_io_metrics(spark):
    df = spark.createDataFrame([('{"a":"é"}',), ("",), ("{",)], "value string")
    row = records.io_metrics(records.with_verdict(df)).first()
    assert (row["bytes_read"], row["read_operations"], row["error_count"]) == (11 + 1 + 2, 3, 1)


def test_white_space_is_pythons():
    assert set(WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_blank_to_null(spark):
    texts = [" a b ", " x\t", "  ", "", None, "N/A", " N/A ", "nan"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    out = df.select("id", fields.blank_to_null(F.col("t"), fields.MISSING_MARKERS).alias("t")).collect()
    assert [r["t"] for r in sorted(out)] == ["a b", "x", None, None, None, None, "N/A", None]
    assert df.select(strip(F.col("t"))).first()[0] == "a b"


def test_payload(spark):
    df = spark.createDataFrame([("é", None, "", "c", None, 'q"')], ", ".join(f"{n} string" for n in fields.TICKET_FIELDS))
    line = df.select(fields.payload()).first()[0]
    want = dict(zip(fields.TICKET_FIELDS, ["é", "unknown", "", "c", "unknown", 'q"']))
    assert line == json.dumps(want, ensure_ascii=False, separators=(",", ":"))


def test_training_pair(spark):
    notes = "Reset done. Call +1 (555) 010-1234 if needed. It works. Fourth sentence."
    body = "Screen is  black.\nThis email is confidential.\nPlease help\nBest regards\nAnn Other"
    df = spark.createDataFrame([(" Help ", body, notes, "c", None, None)], ", ".join(f"{n} string" for n in fields.TICKET_FIELDS))
    row = fields.training_pairs(df).first()
    assert row["instruction"] == "Help Screen is black.\nPlease help"
    assert row["response"] == "Reset done. Call if needed. It works."
    assert (row["category"], row["subcategory"]) == ("c", "unknown")


def test_model_request_is_json(spark):
    df = spark.createDataFrame([('say "hi"\n',)], "t string")
    request = json.loads(df.select(fields.model_request(F.col("t"), "m")).first()[0])
    assert request["messages"][1] == {"role": "user", "content": 'say "hi"\n'}
    assert request["temperature"] == 0.0 and request["max_tokens"] == 1000
    assert request["response_format"] == fields.response_schema()


def test_word_count(spark):
    df = spark.createDataFrame([("a-b",), ("aéb_c",), ("²½",), ("",)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [2, 1, 1, 0]


GOOD = {
    "instruction": "one two three four five",
    "response": "one two three four five",
    "category": "c",
    "subcategory": "s",
    "assignment_group": "g",
}
TICKET = '{"Short_Description":"x","extra":1}'


def _answer(status, data):
    return json.dumps({"status": status, "data": data}, ensure_ascii=False)


ROUTES = [
    # line, answer, refusal, call class, seconds, error class, error
    (TICKET, _answer("good", GOOD), None, None, 1.0, None, None),
    (TICKET, _answer("good", GOOD), "no", None, 1.0, "refusal", gates.REFUSED),
    (TICKET, None, None, None, 1.0, "refusal", gates.REFUSED),
    (TICKET, _answer("bad", "corrupt"), None, None, 1.0, "model_bad", "corrupt"),
    (TICKET, _answer("bad", ""), None, None, 1.0, "model_bad", gates.NO_REASON),
    (TICKET, _answer("bad", {"z": 1, "a": "é"}), None, None, 1.0, "model_bad", '{"z": 1, "a": "é"}'),
    (TICKET, _answer("good", {**GOOD, "response": "one two three four"}), None, None, 1.0, "too_short", gates.TOO_SHORT),
    (TICKET, _answer("good", {**GOOD, "more": "x"}), None, None, 1.0, "schema_error", gates.SCHEMA_ERROR),
    (TICKET, _answer("good", {**GOOD, "category": 5}), None, None, 1.0, "schema_error", gates.SCHEMA_ERROR),
    (TICKET, _answer("good", "fine"), None, None, 1.0, "no_data", gates.NO_DATA),
    (TICKET, _answer("good", GOOD), None, None, 181.9, "timeout", "Ticket timed out after 181s"),
    (TICKET, _answer("good", GOOD), None, None, 180.0, None, None),
    (TICKET, _answer("fine", "x"), None, None, 1.0, "unexpected", None),
    (TICKET, "not json", None, None, 1.0, "unexpected", None),
    (TICKET, '{"status":"bad","data":"x","more":1}', None, None, 1.0, "unexpected", None),
    (TICKET, '{"status":"good","data":"y","data":"x","status":"bad"}', None, None, 1.0, "model_bad", "x"),
    (TICKET, None, None, "api_error", 1.0, "api_error", "API Error (final): boom"),
    (TICKET, None, None, "breaker_open", 1.0, "breaker_open", gates.BREAKER_OPEN),
    (TICKET, None, None, "rate_limited", 1.0, "rate_limited", gates.RATE_LIMITED),
    (TICKET, None, None, "unexpected", 1.0, "unexpected", "Worker unexpected final fail: boom"),
    ("{", _answer("good", GOOD), None, None, 1.0, "invalid_json", None),
    ('{"Category":5}', _answer("good", GOOD), None, None, 1.0, "invalid_shape", None),
    ("[1]", _answer("good", GOOD), None, None, 1.0, "invalid_shape", None),
    ('{"Category":"\\ud800"}', _answer("good", GOOD), None, None, 1.0, "invalid_unicode", None),
]


def test_routes(spark):
    rows = [(i, *r[:5], "boom") for i, r in enumerate(ROUTES)]
    schema = "id int, value string, response string, refusal string, call_class string, seconds double, call_error string"
    lines = gates.raw_tickets(spark.createDataFrame(rows, schema))
    routed = gates.classify(
        lines, refusal="refusal", call_class="call_class", call_error="call_error", seconds="seconds"
    )
    got = {r["id"]: r for r in routed.collect()}
    assert len(got) == len(ROUTES)
    for i, route in enumerate(ROUTES):
        row, want_class, want_error = got[i], route[5], route[6]
        assert row["error_class"] == want_class, (route, row["error_class"], row["error"])
        assert row["status"] == ("good" if want_class is None else "bad")
        if want_error is not None:
            assert row["error"] == want_error
        if want_class is None:
            assert row["ticket"].asDict() == GOOD
        else:
            assert row["error"] and row["ticket"] is None
    assert json.loads(got[0]["request_payload"])["Description"] == "unknown"


def test_settings():
    assert Settings().ema_alpha == 0.05
    for wrong in (
        {"min_word_count": -1},
        {"bad_ratio_stop": 99.0},
        {"ema_alpha": 0.0},
        {"bad_ratio_warning": 0.995},
        {"max_attempts": 0},
        {"ticket_timeout_seconds": -1},
    ):
        with pytest.raises(ValueError):
            Settings(**wrong)


def test_settings_reach_the_operators(spark, folder):
    """Other settings than the defaults change what the queries do."""
    from ticketmill.plans import curation, sequences

    strict = curation.routed(spark, folder, Settings(ticket_timeout_seconds=1.0))
    assert strict.filter("error_class = 'timeout'").count() > curation.routed(spark, folder).filter("error_class = 'timeout'").count()
    quick = sequences.bad_ratio_ema(spark, folder, Settings(ema_alpha=1.0))
    assert {r["ema"] for r in quick.select("ema").distinct().collect()} == {0.0, 1.0}


def test_a_model_is_asked_once_and_only_for_accepted_lines(spark, tmp_path):
    lines = [TICKET, TICKET, "{", "[1]"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id long, value string").coalesce(1)
    log = str(tmp_path / "calls")

    def model(requests):
        with open(log, "a") as out:
            out.writelines(f"{r}\n" for r in requests)
        return requests.map(lambda r: '{"status":"bad","data":"no"}')

    def asked():
        with open(log) as made:
            calls = made.readlines()
        open(log, "w").close()
        return calls

    answered = gates.with_model(gates.raw_tickets(df), model)
    assert answered.filter("response <> ''").count() == 2
    calls = asked()
    assert len(calls) == 2 and "None\n" not in calls
    routed = gates.classify(answered).withColumn("key", F.lit(1))
    averaged = sequence.ema(routed, "key", ["id"], F.col("status") == "bad")
    assert averaged.count() == 4 and len(asked()) == 2


def test_transactions_are_answers_that_came(spark):
    rows = [
        (1, '{"status":"bad","data":"no"}', None),
        (2, None, None),
        (3, "nonsense", None),
        (4, "I cannot", "refused"),
        (5, None, "refused"),
    ]
    df = spark.createDataFrame([(i, TICKET, r, f) for i, r, f in rows], "id long, value string, response string, refusal string")
    routed = gates.classify(gates.raw_tickets(df), refusal="refusal")
    assert sorted(r["id"] for r in routed.filter("answered").collect()) == [1, 4]
