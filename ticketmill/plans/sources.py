"""Registered queries over files written from the tables: scans, encodings, compressed files, listing, counted sinks."""

from __future__ import annotations

import lzma
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.detectors import Detector
from ..functions.fields import EXPORT_COLUMNS, MISSING_MARKERS, TICKET_FIELDS
from ..operators import counted, records, redaction
from ..session import run_folder
from ..sources import bounded, encodings, files
from ..sources.ranges import list_files, located
from . import records as record_plans
from . import tables
from .tables import TICKETS_SQL, table

CHUNK = 4_000  # lines of a trigger
PACKED_BYTES = 1 << 16  # of an .xz block
PIECE_BYTES = 4 << 20  # of a file in a row


def _event_lines(spark: SparkSession, folder: str, name: str = "events") -> str:
    """The event log as a folder of JSON lines."""
    written = run_folder(spark, name)
    table(spark, folder, "events").select("event_id", "user_id", "event_type").write.json(written)
    return written


def _event_fields(lines: DataFrame) -> DataFrame:
    parsed = F.from_json("value", "event_id long, user_id long, event_type string")
    return lines.select(parsed.alias("e")).select("e.event_id", "e.user_id", "e.event_type")


def bounded_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events read from line files in triggers of CHUNK lines: a file is several triggers, none holds more."""
    run = run_folder(spark, "bounded")
    chunks = bounded.index_lines(spark, _event_lines(spark, folder), f"{run}/index", CHUNK, "part-*")

    def started(lines: DataFrame, lane: int, checkpoint: str) -> StreamingQuery:
        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{run}/out/lane={lane}/batch={number}")

        return _event_fields(lines).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()

    lanes = bounded.stream_lanes(spark, f"{run}/index", f"{run}/checkpoint", chunks)
    bounded.finish(*[started(lines, i, checkpoint) for i, (lines, checkpoint) in enumerate(lanes)])
    rows = spark.read.parquet(f"{run}/out")
    sizes = rows.groupBy("lane", "batch").agg(F.count("*").alias("n"))
    return rows.join(F.broadcast(sizes), ["lane", "batch"]).select("event_id", "user_id", "event_type", (F.col("n") <= CHUNK).alias("within"))


_LATIN = "^[\\x00-\\x7F\\u00A0-\\u00FF]*$"


def decoded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written in UTF-8, UTF-16 and a one-byte encoding, found out by byte range and read back line by line."""
    run = run_folder(spark, "encodings")
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kinds = {"ISO-8859-1": F.col("text").rlike(_LATIN) & (F.col("doc_id") % 3 == 0), "UTF-16": F.col("doc_id") % 3 == 1}
    left: Column = F.lit(True)
    for charset, chosen in kinds.items():
        docs.filter(chosen).write.option("encoding", charset).json(f"{run}/{charset}")
        left = left & ~chosen
    docs.filter(left).write.json(f"{run}/utf-8")
    listed = list_files(spark, run, "part-*.json")
    lines = encodings.lines_in_encodings(listed, range_bytes=1 << 20)
    parsed = lines.select(F.from_json("value", "doc_id long, text string").alias("d")).select("d.*")
    return parsed.select("doc_id", F.char_length("text").cast("long").alias("chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


def _pack(target: str):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A file a task, a block for each PACKED_BYTES of lines; a task that runs again writes the same file."""
        from pyspark import TaskContext

        system, path = located(target)
        system.create_dir(path, recursive=True)
        name = f"{path}/events-{TaskContext.get().partitionId():05d}.jsonl.xz"
        held, count = bytearray(), 0
        with system.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for line in batch.column(0).to_pylist():
                    held += line.encode() + b"\n"
                    count += 1
                    if len(held) >= PACKED_BYTES:
                        out.write(lzma.compress(bytes(held), preset=0))
                        held.clear()
            out.write(lzma.compress(bytes(held), preset=0))
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["lines"])

    return packed


def packed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events packed as .xz files of many blocks and read back block by block."""
    target = run_folder(spark, "packed")
    lines = table(spark, folder, "events").select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))
    lines.repartition(3).mapInArrow(_pack(target), "lines long").agg(F.sum("lines")).collect()
    return _event_fields(files.read_compressed(spark, target))


def discovered_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Files found below a folder, one language's folder ignored: how many lines and characters each folder holds."""
    run = run_folder(spark, "tree")
    docs = table(spark, folder, "documents").select("lang", F.translate(F.coalesce("text", F.lit("")), "\r\n", "  ").alias("value"))
    docs.filter("lang IS NOT NULL").write.partitionBy("lang").text(run)
    found = files.discover_files(spark, run, "part-*.txt", ["lang=de"], piece=PIECE_BYTES)
    lang = F.regexp_extract("path", "^lang=([^/]*)/", 1)
    sizes = F.regexp_count("content", F.lit("\n")).cast("long")
    return found.groupBy(lang.alias("lang")).agg(F.sum(sizes).alias("lines"), F.sum(F.char_length("content") - sizes).cast("long").alias("chars"))


def exported_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets exported under three different headers in one folder, read back by one scan."""
    run = run_folder(spark, "export")
    tickets = tables.tickets(spark, folder)
    named = [F.col(f).alias(h) for f, h in EXPORT_COLUMNS.items()]
    third = F.col("ticket_id") % 3
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    tickets.filter(third == 0).select(*named).write.options(**options).csv(f"{run}/a")
    tickets.filter(third == 1).select(F.col("ticket_id").alias("Number"), *reversed(named)).write.options(**options).csv(f"{run}/b")
    tickets.filter(third == 2).select(*named[1:]).write.options(**options).csv(f"{run}/c")
    return files.read_export(spark, run)


def write_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What a counted write of the event log reports; one record in 97 has a number that JSON cannot hold."""
    x = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan")))
    rows = table(spark, folder, "events").select("event_id", "event_type", x.alias("x"))
    return counted.write_counted(rows, run_folder(spark, "counted")).select("records", "bytes", "skipped")


def scanned_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Spoilt event lines written as compressed text and scanned again: how many lines got which verdict."""
    run = run_folder(spark, "lines")
    tables.spoilt_lines(spark, folder).select(F.coalesce("value", F.lit("")).alias("value")).write.option("compression", "gzip").text(run)
    judged = records.with_verdict(files.read_lines(spark, run), dump=False)
    verdict = F.when(F.col("json.verdict").isin("ok", "blank"), F.col("json.verdict")).otherwise("invalid")
    return judged.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("lines"))


INCIDENT = Detector("INCIDENT", r"\bINC[0-9]{7}\b", 0.9, hint="INC")


def own_detector(spark: SparkSession, folder: str) -> DataFrame:
    """Ticket titles redacted by a detector of the caller's own."""
    titles = tables.tickets(spark, folder).select("ticket_id", "Short_Description")
    return redaction.redact_columns(titles, ["Short_Description"], [INCIDENT])


QUERIES = {
    f.__name__: f
    for f in (scanned_lines, own_detector, bounded_lines, decoded_documents, packed_events, discovered_documents, exported_tickets, write_metrics)
}

_MARKERS = ", ".join(f"'{m}'" for m in MISSING_MARKERS)
_CLEAN = {n: f"CASE WHEN {n} NOT IN ({_MARKERS}) THEN nullif(trim({n}), '') END" for n in TICKET_FIELDS}
_DROPPED = next(iter(EXPORT_COLUMNS))  # is missing from a third of the exports
_CLEAN[_DROPPED] = f"CASE WHEN ticket_id % 3 <> 2 THEN {_CLEAN[_DROPPED]} END"
_EVENTS = "SELECT event_id, user_id, event_type FROM events"

ORACLES = {
    "bounded_lines": "SELECT event_id, user_id, event_type, true AS within FROM events",
    "decoded_documents": "SELECT doc_id, length(coalesce(text, '')) AS chars, md5(coalesce(text, '')) AS digest FROM documents",
    "packed_events": _EVENTS,
    "scanned_lines": f"""SELECT verdict, count(*) AS lines FROM ({record_plans.ORACLES["json_verdicts"]}) GROUP BY verdict""",
    "own_detector": f"""WITH {TICKETS_SQL} SELECT ticket_id,
        regexp_replace(Short_Description, 'INC[0-9]{{7}}', '<REDACTED>') AS Short_Description FROM tickets""",
    "discovered_documents": """SELECT lang, count(*) AS lines, sum(length(coalesce(text, ''))) AS chars
        FROM documents WHERE lang <> 'de' GROUP BY lang""",
    "exported_tickets": f"WITH {TICKETS_SQL} SELECT {', '.join(f'{e} AS {n}' for n, e in _CLEAN.items())} FROM tickets",
    "write_metrics": """SELECT count(*) FILTER (event_id % 97 <> 0) AS records, count(*) FILTER (event_id % 97 = 0) AS skipped,
        sum(strlen(concat('{"event_id":', event_id, ',"event_type":"', event_type, '","x":null}')) + 1)
            FILTER (event_id % 97 <> 0) AS bytes FROM events""",
}
