"""Redaction: fixtures, both back ends, memo, names, context."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketmill.functions import span_udfs, spans
from ticketmill.functions.detectors import (
    BADGE,
    CARD,
    DEFAULT_DETECTORS,
    EMAIL,
    IP,
    MACHINE,
    PHONE,
    TICKET,
    WITH_CUSTOM,
    Detector,
    operators_for,
)
from ticketmill.operators import names, redaction

CASES = [
    ("badge 123456 ok", WITH_CUSTOM, "badge <BADGE_NUMBER> ok"),
    ("badge 123456 ok", DEFAULT_DETECTORS, "badge 123456 ok"),
    ("1234567", WITH_CUSTOM, "<MACHINE_NAME>"),
    ("é123456", WITH_CUSTOM, "é123456"),
    ("see inc0012 and REQ7", WITH_CUSTOM, "see <TICKET_NUMBER> and <TICKET_NUMBER>"),
    ("host PC-01_A", WITH_CUSTOM, "host <MACHINE_NAME>"),
    ("I am on Monday", WITH_CUSTOM, "<MACHINE_NAME> am on Monday"),
    ("X-123456", WITH_CUSTOM, "X-<BADGE_NUMBER>"),
    ("PC-01x A__B PC-A_1-", WITH_CUSTOM, "<MACHINE_NAME>-01x A__B <MACHINE_NAME>-"),
    ("mail a.b@mail5.example.com now", DEFAULT_DETECTORS, "mail <EMAIL_ADDRESS> now"),
    ("mail A@EXAMPLE.COM", WITH_CUSTOM, "mail <EMAIL_ADDRESS>"),
    ("+1 (743) 555-3824", DEFAULT_DETECTORS, "<PHONE_NUMBER>"),
    ("70.23.22.57", DEFAULT_DETECTORS, "<IP_ADDRESS>"),
    ("999.1.1.1", DEFAULT_DETECTORS, "999.1.1.1"),
    ("1.2.3.4.5", DEFAULT_DETECTORS, "1.2.3.4.5"),
    ("4111111111111111 x", DEFAULT_DETECTORS, "<REDACTED> x"),
    ("4111-1111 1111-1111", DEFAULT_DETECTORS, "<REDACTED>"),
    ("4111111111111112 x", DEFAULT_DETECTORS, "4111111111111112 x"),
    (
        "see https://x.example.com/a?b=1 or a@b.co, 10.1.2.3.",
        DEFAULT_DETECTORS,
        "see <REDACTED> or <EMAIL_ADDRESS>, <IP_ADDRESS>.",
    ),
    ("", WITH_CUSTOM, ""),
    (None, WITH_CUSTOM, None),
]


@pytest.mark.parametrize("backend", ["native", "arrow"])
def test_cases(spark, backend):
    for detectors in (DEFAULT_DETECTORS, WITH_CUSTOM):
        chosen = [(t, want) for t, ds, want in CASES if ds is detectors]
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(chosen)], "id int, text string")
        out = df.select("id", redaction.redact(F.col("text"), detectors, backend=backend).alias("text"))
        got = {r["id"]: r["text"] for r in out.collect()}
        assert [got[i] for i in range(len(chosen))] == [want for _, want in chosen]


PIECES = [
    "a.b@mail5.example.com", "+1 (743) 555-3824", "555-123-4567", "10.0.0.1", "1.2.3.4.5", "INC0001", "req9",
    "123456", "X-123456", "4111111111111111", "https://a.example.com/x?m=a@b.co", "PC-01_A", "é", "²½", " ",
    "\n", ".", "-", "_", "(", "word", "I", "42", "🙂", "@", "://", "+1",
]


def _random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(1, 25))) for _ in range(n)]


def test_back_ends_agree_on_random_texts(spark):
    texts = _random_texts(11, 600)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    for detectors in (DEFAULT_DETECTORS, WITH_CUSTOM):
        text = F.col("text")
        out = df.select(
            "text",
            redaction.redact(text, detectors, backend="native").alias("a"),
            redaction.redact(text, detectors, backend="arrow").alias("b"),
            redaction.redact(text, detectors, memo=64).alias("c"),
            F.array_sort(spans.find_spans(text, detectors)).alias("sa"),
            F.array_sort(span_udfs.find_spans(text, detectors)).alias("sb"),
            spans.resolve_spans(spans.find_spans(text, detectors)).alias("kept"),
        ).collect()
        for r in out:
            assert r["a"] == r["b"] == r["c"], r["text"]
            assert r["sa"] == r["sb"], r["text"]
            ends = [(s["start"], s["end"]) for s in r["kept"]]
            assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_hints_never_hide_a_match(spark):
    texts = _random_texts(12, 400)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for d in WITH_CUSTOM:
        missed = df.filter(F.regexp_count("text", F.lit(d.pattern)) > 0).filter(
            ~spans.hint_test(F.col("text"), [d])
        )
        assert missed.count() == 0


def test_equal_length_and_prefix_give_their_own_results(spark):
    head = "x" * 100
    df = spark.createDataFrame([(head + " a@b.co",), (head + " c@d.co",), (head + " plain.",)], "text string")
    out = [r[0] for r in df.select(redaction.redact(F.col("text"), [EMAIL], memo=8)).collect()]
    assert sorted(out) == sorted([head + " <EMAIL_ADDRESS>"] * 2 + [head + " plain."])


def test_other_columns_and_languages_pass_through(spark):
    df = spark.createDataFrame(
        [(1, "a@b.co", "en", 2.5, ["a@b.co"]), (2, "a@b.co", "fr", None, []), (3, "a@b.co", None, None, None)],
        "id int, text string, lang string, n double, parts array<string>",
    )
    out = {r["id"]: r for r in redaction.redact_columns(df, ["text"], language=F.col("lang")).collect()}
    assert out[1]["text"] == "<EMAIL_ADDRESS>" and out[2]["text"] == "a@b.co" and out[3]["text"] == "a@b.co"
    assert out[1]["parts"] == ["a@b.co"] and out[1]["n"] == 2.5


def test_detectors_of_a_language(spark):
    german = Detector("NUMMER", r"\bNr [0-9]+\b", 0.9, hint="Nr ", language="de")
    rows = [(1, "de", "Nr 5 a@b.co"), (2, "en", "Nr 5 a@b.co"), (3, "fr", "Nr 5 a@b.co"), (4, None, "Nr 5"), (5, "de", None)]
    df = spark.createDataFrame(rows, "id int, lang string, text string")
    out = redaction.redact_columns(df, ["text"], [EMAIL, german], language=F.col("lang"), languages=("de", "en"))
    got = {r["id"]: r["text"] for r in out.collect()}
    assert got == {1: "<REDACTED> <EMAIL_ADDRESS>", 2: "Nr 5 <EMAIL_ADDRESS>", 3: "Nr 5 a@b.co", 4: "Nr 5", 5: None}


def test_json_records(spark):
    line = '{"a":"x@y.co","b":5,"c":null,"d":{"e":"x@y.co"},"f":["x@y.co"],"g":""}'
    df = spark.createDataFrame([(line,), ("[1]",), ("{bad",)], "value string")
    top = [r[0] for r in redaction.redact_json_lines(df).collect()]
    assert top == [
        '{"a": "<EMAIL_ADDRESS>", "b": 5, "c": null, "d": {"e": "x@y.co"}, "f": ["x@y.co"], "g": ""}',
        None,
        None,
    ]
    deep = redaction.redact_json_lines(df, deep=True).first()[0]
    assert "x@y.co" not in deep and '"f": ["<EMAIL_ADDRESS>"]' in deep


def test_every_line_gives_a_record_or_a_reason(spark):
    deep = '{"a":' + "[" * 3000 + '"x@y.co"' + "]" * 3000 + "}"
    lines = {
        '{"a":"x@y.co"}': None,
        '{"a":"\\ud800"}': "invalid_unicode",
        '{"a":' + "9" * 5000 + "}": "invalid_json",
        "[1]": "not_an_object",
        "{": "invalid_json",
        "": "invalid_json",
        "[" * 200_000: "too_deep",
    }
    rows = [*lines, None, deep]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows)], "id int, value string, reject string")
    for nested in (False, True):
        out = {r["id"]: r for r in redaction.redact_json_lines(df, deep=nested).collect()}
        assert len(out) == len(rows)
        assert [out[i]["reject"] for i in range(len(lines))] == list(lines.values())
        assert out[len(lines)]["reject"] == "missing"
        assert all((r["value"] is None) == (r["reject"] is not None) for r in out.values())
        last = out[len(lines) + 1]
        assert last["reject"] in (None, "too_deep") and (not nested or "x@y.co" not in (last["value"] or ""))
    broken = df.limit(1).select("id", F.lit(b"{\xff}").cast("string").alias("value"))
    assert redaction.redact_json_lines(broken).first()["reject"] == "invalid_unicode"


def test_distinct_with_a_map_column(spark):
    df = spark.createDataFrame([(1, "a@b.co", {"k": 1}), (2, "a@b.co", None), (3, "x", {})], "id int, text string, m map<string,int>")
    out = {r["id"]: (r["text"], r["m"]) for r in redaction.redact_distinct(df, "text").collect()}
    assert out == {1: ("<EMAIL_ADDRESS>", {"k": 1}), 2: ("<EMAIL_ADDRESS>", None), 3: ("x", {})}


def test_cards_are_analysed_once(spark, folder):
    from ticketmill.plans import redaction as plans

    plan = plans.redact_cards(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") + plan.count("regexp_instr") <= plan.count("Generate") + 1 and "Filter (size" not in plan


def test_failure_marker_keeps_the_record_and_hides_the_text(spark, monkeypatch):
    def broken(*_):
        def run(text):
            raise RuntimeError(text)

        return run

    monkeypatch.setattr(span_udfs, "make_redactor", broken)
    df = spark.createDataFrame([(1, "a@b.co")], "id int, text string")
    redacted = df.withColumn("text", span_udfs.redact_text(F.col("text"), [EMAIL]))
    row = redacted.select("*", redaction.failed_columns(["text"]).alias("failed")).first()
    assert row["id"] == 1 and row["text"] == "<REDACTION_ERROR: RuntimeError>" and row["failed"] == ["text"]


def test_redact_distinct_equals_redact_with_a_hot_text(spark):
    rows = [(i, "hot a@b.co") for i in range(600)] + [(600 + i, f"t{i} 10.0.0.{i % 250}") for i in range(300)]
    rows += [(900 + i, "nothing") for i in range(50)] + [(950, ""), (951, None)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(6)
    want = redaction.redact_columns(df, ["text"])
    got = redaction.redact_distinct(df, "text", salts=8, share=3)
    assert sorted(got.collect(), key=lambda r: r["id"]) == sorted(want.collect(), key=lambda r: r["id"])
    same = df.drop("id")
    again = redaction.redact_distinct(same, "text", salts=8, share=3)
    assert again.groupBy("text").count().filter("text = 'hot <EMAIL_ADDRESS>'").first()["count"] == 600


def test_hot_values_are_found_in_one_pass(spark, monkeypatch):
    """All values over 1/share of the rows, few others, whatever is spread over how many tasks."""
    rows = [("a",)] * 300 + [("b",)] * 120 + [(f"x{i}",) for i in range(600)] + [(None,)] * 400
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "text string").repartition(7)
    hashes = {r.h: r.text for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    for share, least in ((5, {"a"}), (20, {"a", "b"}), (4, set())):
        hot = {hashes[r[0]] for r in redaction.hot_values(df, F.col("text"), share).collect()}
        assert least <= hot <= {"a", "b"} and len(hot) < 2 * share
    assert redaction.hot_values(df.limit(0), F.col("text"), 5).count() == 0


def test_a_sketch_keeps_what_is_frequent():
    rng = random.Random(9)
    values = [rng.choice([1, 1, 1, 2, 2, rng.randrange(10, 5000)]) for _ in range(20_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + 700], pa.int64())], names=["h"]) for i in range(0, 20_000, 700)]
    (got,) = redaction._sketched(40)(iter(batches))
    counts = dict(zip(got["__hash"].to_pylist(), got["copies"].to_pylist()))
    exact = Counter(values)
    assert len(counts) <= 41 and counts[None] == 20_000
    assert all(exact[v] - 20_000 / 40 <= n <= exact[v] for v, n in counts.items() if v is not None) and {1, 2} <= counts.keys()


def test_context_raises_the_score(spark):
    texts = ["employee ID 123456", "ID   number: 123456", "123456 is my badge number", "number 123456",
             "badge number one two three four five 123456"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    found = df.select("id", redaction.analyze(F.col("text"), [BADGE], context=True)[0]["score"].alias("s"))
    scores = {r["id"]: r["s"] for r in found.collect()}
    assert [scores[i] for i in range(5)] == [1.0, 1.0, 1.0, 0.8, 0.8]
    with pytest.raises(ValueError):
        redaction.analyze(F.col("text"), [BADGE], context=True, backend="native")


@pytest.mark.parametrize("ship", [True, False])
def test_known_names(spark, ship):
    people = spark.createDataFrame([("Ada Lovelace",), ("Lovelace",), (" Zoë ",), ("",), (None,)], "name string")
    df = spark.createDataFrame(
        [(1, "Ada Lovelace met Zoë."), (2, "Lovelaces"), (3, ""), (4, None), (5, "Lovelace, Ada")],
        "id int, text string",
    )
    out = {r["id"]: r["text"] for r in names.mask_names(df, "id", "text", people, ship=ship).collect()}
    assert out == {1: "<PERSON> met <PERSON>.", 2: "Lovelaces", 3: "", 4: None, 5: "<PERSON>, Ada"}


@pytest.mark.parametrize("ship", [True, False])
def test_long_and_dotted_names(spark, ship):
    people = spark.createDataFrame(
        [("Maria de la Cruz Santos Ibarra",), ("Sammy Davis Jr.",), ("Ann Lee",), ("'t Hooft",), ("***",), ("Ann Lee",)],
        "name string",
    )
    texts = [
        "Maria de la Cruz Santos Ibarra met Ann Lee.",
        "Sammy Davis Jr. and Sammy Davis Jr, Ann  Lee",
        "by G. 't Hooft, not t Hooft",
        "Sammy Davis Jr.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = [r["text"] for r in names.mask_names(df, "id", "text", people, ship=ship).orderBy("id").collect()]
    assert out == [
        "<PERSON> met <PERSON>.",
        "<PERSON> and Sammy Davis Jr, Ann  Lee",
        "by G. <PERSON>, not t Hooft",
        "<PERSON>",
    ]
    assert [r["name"] for r in names.unmatchable_names(people).collect()] == ["***"]


@pytest.mark.parametrize("ship", [True, False])
def test_repeated_and_null_keys_keep_their_own_spans(spark, ship):
    people = spark.createDataFrame([("Ann Lee",)], "name string")
    rows = [(1, "Ann Lee here"), (1, "that person Ann"), (1, "so Ann Lee"), (1, "Ann Lee here"), (None, "Ann Lee")]
    df = spark.createDataFrame(rows, "id int, text string")
    out = sorted(r["text"] for r in names.mask_names(df, "id", "text", people, ship=ship).collect())
    assert out == ["<PERSON>", "<PERSON> here", "<PERSON> here", "so <PERSON>", "that person Ann"]


def test_both_ways_give_the_same_spans_over_all_customers(spark, folder, monkeypatch):
    people = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_name").alias("name"))
    df = people.select(F.monotonically_increasing_id().alias("id"), F.concat(F.lit("ask "), "name", F.lit(" or Customer#000000001")).alias("text"))
    spans_of = lambda ship: {r["id"]: sorted(map(tuple, r["name_spans"])) for r in names.name_spans(df, "id", "text", people, ship=ship).collect()}
    shipped = spans_of(True)
    assert shipped == spans_of(False) and all(len(v) == 2 for v in shipped.values())
    monkeypatch.setattr(names, "MAX_NAMES", 10)
    with pytest.raises(ValueError):
        names.name_spans(df, "id", "text", people, ship=True)


def test_names_in_parts_move_no_text(spark, monkeypatch):
    """Names that share their first word, names in names, and rows held in several groups: as shipped."""
    monkeypatch.setattr(names, "PART_NAMES", 30)
    rng = random.Random(5)
    words = ["Ann", "Lee", "de", "la", "Cruz", "Jr."]
    listed = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(150)} | {f"Ann {i}" for i in range(100)})
    people = spark.createDataFrame([(n,) for n in listed], "name string")
    texts = [" ".join(rng.choice([*words, "met", f"{rng.randrange(120)}"]) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(None, None, 1), (1, "Ann", 2)], "id int, text string, name_spans int")
    spans_of = lambda ship: sorted((r["id"] is None, r["id"], r["text"], sorted(map(tuple, r["name_spans"]))) for r in names.name_spans(df, "id", "text", people, ship=ship).collect())
    want = spans_of(True)
    assert spans_of(False) == want and sum(len(r[3]) for r in want) > 500
    plan = names.name_spans(df, "id", "text", people, ship=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_names_hold_few_bytes_of_rows_and_compare_equal_hashes(monkeypatch):
    """A large batch is cut to what a task may hold; names are told apart where their hashes are not."""
    text = "Ann de la Cruz met Ann Lee and (Bo) and Bo " + "x" * 400
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 100_000)], names=["t"])
    groups = list(names._groups([batch, batch.slice(0, 10)]))
    assert sum(b.num_rows for g in groups for b in g) == 100_010
    assert max(sum(b.nbytes for b in g) for g in groups) <= 16 << 20
    plain = names._hashes
    monkeypatch.setattr(names, "_hashes", lambda texts: plain(texts) % 3)
    listed = [("", "Ann de la Cruz", ""), ("", "Ann", ""), ("(", "Bo", ")"), ("", "met Ann Lee", ""), ("", "Lee", "")]
    parts = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*listed)], names=["head", "core", "tail"])
    begun = pa.Table.from_batches(names._begun([parts])).sort_by([("level", "ascending"), ("hash", "ascending")])
    found = names._mentions(["", text], [begun.slice(i, 2) for i in range(0, begun.num_rows, 2)])
    want = sorted((b, b + len(n)) for n, b in (("Ann de la Cruz", 0), ("Ann", 0), ("met Ann Lee", 15), ("Ann", 19), ("Lee", 23), ("(Bo)", 31)))
    assert set(found) == {1} and sorted({(b, e) for b, e, *_ in found[1]}) == want


def test_operators_and_detectors_are_checked(spark):
    assert operators_for({"PERSON": "X"})["PERSON"] == "X"
    row = spark.range(1).select(
        redaction.replacement_of(F.lit("URL")).alias("url"), redaction.replacement_of(F.lit("PERSON")).alias("p")
    ).first()
    assert (row["url"], row["p"]) == ("<REDACTED>", "<PERSON>")
    for wrong in (
        lambda: Detector("", "a", 0.5),
        lambda: Detector("A", "a", 1.5),
        lambda: Detector("A", "a*", 0.5),
        lambda: Detector("A", "a", 0.5, check="other"),
        lambda: redaction.redact(F.col("x"), [EMAIL], backend="other"),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_custom_detector(spark):
    asset = Detector("ASSET", r"\bAS-[0-9]{4}\b", 0.9, hint="AS-")
    df = spark.createDataFrame([("see AS-1234",)], "text string")
    for backend in ("native", "arrow"):
        out = redaction.redact(F.col("text"), [asset], {"ASSET": "<ASSET>"}, backend=backend)
        assert df.select(out).first()[0] == "see <ASSET>"


def test_names_and_detectors_compete(spark):
    people = spark.createDataFrame([("Ada",), ("a@b",)], "name string")
    df = spark.createDataFrame([(1, "Ada wrote a@b.co from 10.0.0.1")], "id int, text string")
    out = names.mask_names(df, "id", "text", people, detectors=[EMAIL, IP]).first()
    assert out["text"] == "<PERSON> wrote <EMAIL_ADDRESS> from <IP_ADDRESS>"


def test_a_callers_own_detector(spark):
    @F.pandas_udf(spans.SPANS)
    def shouting(texts):
        return texts.map(
            lambda t: [{"start": i, "end": i + 4, "entity": "SHOUT", "score": 0.7} for i in [t.find("HELP")] if i >= 0]
        )

    df = spark.createDataFrame([("please HELP a@b.co",), ("calm",)], "text string")
    found = [shouting("text"), redaction.analyze(F.col("text"), [EMAIL])]
    out = df.select(redaction.redact_spans(F.col("text"), found, {"SHOUT": "<SHOUT>"})).collect()
    assert [r[0] for r in out] == ["please <SHOUT> <EMAIL_ADDRESS>", "calm"]


def test_luhn(spark):
    df = spark.createDataFrame([("4111111111111111",), ("4111111111111112",), ("5500 0000 0000 0004",)], "n string")
    assert [r[0] for r in df.select(spans.passes_luhn(F.col("n"))).collect()] == [True, False, True]
    assert len([d for d in (EMAIL, PHONE, IP, CARD, TICKET, MACHINE)]) == 6


def test_redaction_has_no_shuffle(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for options in ({"backend": "native"}, {"backend": "arrow"}, {"memo": 16}):
        plan = redaction.redact_columns(docs, ["text"], [EMAIL, IP], **options)._jdf.queryExecution().executedPlan()
        assert "Exchange" not in plan.toString()
    native = redaction.redact_columns(docs, ["text"], [EMAIL, IP], backend="native")
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
