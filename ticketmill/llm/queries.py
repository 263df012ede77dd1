"""The registered queries of this folder, one per operator, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_folder
from . import alignment, conversations, exact_dedup, jaccard, language, main_text, packing, pieces, pii, sharding, simhash, warc, wordpiece
from .common import table

WORD_MODEL, PIECE_MODEL, BYTE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """The place of an installed tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents"), rule=jaccard.Rule(width=3, num=90, den=100))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), tokenizer_file(WORD_MODEL))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.report(table(spark, folder, "documents").select("doc_id", "text"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = [f"shard-{i:04}" for i in range(256)]
    return sharding.place(table(spark, folder, "documents").select("doc_id"), shards)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wordpiece.document_counts(table(spark, folder, "documents"), tokenizer_file(PIECE_MODEL))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.identified(documents).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "spans")
    found = found.withColumn("base", F.filter("spans", lambda s: s.base))
    kinds = F.transform("base", lambda s: s.kind)
    number = [F.size(F.filter(kinds, lambda kind: kind == k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]  # noqa: B023
    return found.select(
        "doc_id",
        *number,
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, folder, "documents"))


def op9_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    archives = run_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded_digests(table(spark, folder, "documents"), tokenizer_file(PIECE_MODEL))


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = main_text.with_main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignments(table(spark, folder, "documents"), tokenizer_file(BYTE_MODEL), tokenizer_file(PIECE_MODEL))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_sharding": op4_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_personal_data": op7_personal_data,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc_archives": op9_warc_archives,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_main_text": op11_main_text,
    "op12_alignment": op12_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": """
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
                lambda i: array_to_string(w[i:i + 2], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
            FROM words),
        items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS total, count(*) AS shared
            FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 90 * (total - shared)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (
            SELECT doc_id, doc_id AS r FROM documents
            UNION SELECT x.doc_id, e.b FROM reached x JOIN edges e ON x.r = e.a)
        SELECT sets.doc_id, any_value(len(s)) AS n_shingles, min(r) AS component_id
        FROM sets JOIN reached ON sets.doc_id = reached.doc_id GROUP BY sets.doc_id""",
    "op8_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id,
            min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size,
            row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
            text_sha256
        FROM texts""",
    "op9_warc_archives": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
        digests AS (
            SELECT digest, max(page_id) AS response_id, CAST(CAST(unhex(digest) AS BIT) AS VARCHAR) AS bits
            FROM payloads GROUP BY digest)
        SELECT page_id,
            strlen(html) AS payload_bytes,
            list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + CAST(CAST(substr(bits, 5 * i + 1, 5) AS BIT) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response_id THEN response_id END AS refers_to
        FROM payloads JOIN digests USING (digest)""",
    "op13_conversation_repair": """
        WITH RECURSIVE drawn AS (
            SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(k)),
                    lambda p: ('0x' || substr(hex(k), 2 * p + 1, 2))::BIGINT)),
                    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
                        lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS draw
            FROM (SELECT *, encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS k FROM conversations)),
        damaged AS (
            SELECT conv, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
                CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(CASE draw WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) FROM drawn)),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, h) AS i,
                row_number() OVER (PARTITION BY conv, h ORDER BY turn NULLS FIRST) AS same,
                rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
            FROM (SELECT *, md5(role || chr(0) || text) AS h FROM damaged)),
        judged AS (
            SELECT *, CASE WHEN body = '' THEN 'b' WHEN same > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
                left(role, 1) AS initial,
                lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before_it
            FROM placed),
        after_it AS (SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS t(st, nx, name)),
        led AS (
            SELECT st AS before, st, '' AS ins, '' AS put, 0 AS price FROM after_it
            UNION ALL SELECT st, nx, 'I', chr(10) || name || ':', 3 FROM after_it
            UNION ALL SELECT a.st, b.nx, 'II', chr(10) || a.name || ':' || chr(10) || b.name || ':', 6
                FROM after_it a JOIN after_it b ON a.nx = b.st),
        moves AS (
            SELECT before, st AS after, ins || 'D' AS edits, put, price + 4 AS price, 'D' AS letter, '' AS name FROM led
            UNION ALL SELECT before, nx, ins || 'R', put, price + 3, 'R', name FROM led JOIN after_it USING (st)
            UNION ALL SELECT before, nx, ins || 'K', put, price, 'K', left(name, 1) FROM led JOIN after_it USING (st)
            UNION ALL SELECT 0, 1, 'K', '', 0, 'K', 's'),
        walked AS (
            SELECT DISTINCT conv, 0::BIGINT AS i, 0 AS st, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM drawn
            UNION ALL
            SELECT w.conv, w.i + 1, m.after, min({'cost': w.best.cost + m.price + CASE WHEN fault = 't' AND letter <> 'D' THEN 3 ELSE 0 END,
                'audit': w.best.audit || m.edits, 'lines': w.best.lines || m.put || CASE letter WHEN 'D' THEN ''
                    WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || m.name || ':' || text END})
            FROM walked w JOIN judged j ON j.conv IS NOT DISTINCT FROM w.conv AND j.i = w.i + 1
            JOIN moves m ON m.before = w.st AND (letter = 'D' OR fault NOT IN ('b', 'd') AND (letter = 'R' OR m.name = initial))
            GROUP BY w.conv, w.i, m.after),
        ended AS (
            SELECT conv, i, {'cost': best.cost + price, 'audit': best.audit || ins, 'lines': best.lines || put} AS best
            FROM walked JOIN led ON led.before = walked.st AND led.st IN (0, 3)),
        told AS (
            SELECT conv, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (before_it IS NOT NULL AND before_it || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv)
        SELECT e.conv AS conv_id, coalesce(any_value(gaps), 0) AS gaps, coalesce(any_value(blank), 0) AS blank,
            coalesce(any_value(duplicate), 0) AS duplicate, coalesce(any_value(truncated), 0) AS truncated,
            coalesce(any_value(illegal), 0) AS illegal, min(e.best).cost::BIGINT AS cost, min(e.best).audit AS audit,
            sha256(substr(min(e.best).lines, 2)) AS repaired_sha256
        FROM ended e LEFT JOIN told t ON t.conv IS NOT DISTINCT FROM e.conv
        WHERE e.i = coalesce(t.n, 0) GROUP BY e.conv""",
}
