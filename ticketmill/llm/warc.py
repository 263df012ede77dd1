"""WARC archives whose records are Zstandard frames with a shared dictionary.

Layout of a file: one skippable frame that holds the dictionary, then one frame a
record. Spark's text writer makes the files: a row is a frame, and the line
separator is itself an empty skippable frame, so a file is a plain sequence of
frames and the writer's committer makes lost and repeated tasks harmless on any
file system.

Of records with equal payloads the one with the largest id is the response; the
others are revisits that refer to it and carry no payload.

Defined cases: a null payload is an empty one; a null URL is replaced by the
record's own URN; a null id is written as ``-`` and is smaller than any other; of
rows equal in payload, id and URL one is the response and the rest revisit it; no
rows give no files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, stored, text_of

# Magic numbers of skippable frames and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_RECORDS = 1000  # records the dictionary is trained on, chosen by hash
SAMPLE_BYTES = 16 << 10  # of each of them
DICTIONARY_BYTES = 112 << 10
FILE_BYTES = 32 << 20  # payload bytes in one file, so that a file fits a reading task

RECORD = "record_id string, uri string, kind string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(key: str, uri: str | None, digest: str, length: int, payload: bytes | None, refers: str | None, date: str) -> bytes:
    """One WARC/1.1 record; ``payload`` is None for a revisit."""
    urn = f"urn:record:{quote(key)}"
    uri = quote(uri, safe=":/?#[]@!$&'()*+,;=%~") if uri else urn
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: <{urn}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:record:{quote(refers or '-')}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _key(urn: str) -> str:
    return unquote(urn.strip("<>").removeprefix("urn:record:"))


def parse_record(data: bytes) -> tuple:
    """A row of RECORD; fails on a record whose payload does not match its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload), _digest(payload)) != (length, digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: payload and digest differ")
    refers = _key(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return (
        _key(fields["WARC-Record-ID"]),
        fields["WARC-Target-URI"],
        kind,
        refers,
        length,
        digest,
        payload if kind == "response" else None,
    )


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the joined samples where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\nWARC-Type: response\r\n"


def _as_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def archive_records(pages: DataFrame, key: str, uri: str, payload: str, min_bytes: int) -> DataFrame:
    """One row per record to write: _key, _uri, _digest, _bytes, _payload (null: revisit), _refers."""
    text = text_of(payload).cast("binary")
    rows = pages.select(
        F.col(key).alias("_id"),
        F.col(uri).cast("string").alias("_uri"),
        text.alias("_payload"),
        F.sha1(text).alias("_sha"),
        F.octet_length(text).cast("long").alias("_bytes"),
    )
    last = F.struct(F.col("_id").isNotNull(), "_id", F.coalesce("_uri", F.lit("")))
    large = rows.filter(F.col("_bytes") >= min_bytes)
    # The payload is carried once per task and digest; copies are only counted.
    groups = large.groupBy("_sha").agg(
        F.max_by(F.struct("_id", "_uri"), last).alias("_first"),
        F.first("_payload").alias("_payload"),
        F.first("_bytes").alias("_bytes"),
    )
    responses = groups.select("_first._id", "_first._uri", "_sha", "_bytes", "_payload", F.lit(None).cast("string").alias("_refers"))
    listed = stored(large.groupBy("_sha", "_id", "_uri", "_bytes").agg(F.count("*").alias("_copies")), "pages")
    owners = listed.groupBy("_sha").agg(F.max_by(F.struct("_id", "_uri"), last).alias("_first"), F.sum("_copies").alias("_size"))
    owners = stored(owners.filter("_size > 1"), "owners")
    total = listed.agg(F.sum("_copies")).first()[0] or 0
    revisits = (
        join_hot(listed, owners, "_sha", "_size", total)
        .withColumn(
            "_copies",
            F.col("_copies") - F.struct("_id", "_uri").eqNullSafe(F.col("_first")).cast("long"),
        )
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
        .select(
            "_id",
            "_uri",
            "_sha",
            "_bytes",
            F.lit(None).cast("binary").alias("_payload"),
            F.coalesce(F.col("_first._id").cast("string"), F.lit("-")).alias("_refers"),
        )
    )
    small = rows.filter(F.col("_bytes") < min_bytes).select(
        "_id", "_uri", "_sha", "_bytes", "_payload", F.lit(None).cast("string").alias("_refers")
    )
    return (
        responses.unionByName(revisits)
        .unionByName(small)
        .select(F.coalesce(F.col("_id").cast("string"), F.lit("-")).alias("_key"), "_uri", "_sha", "_bytes", "_payload", "_refers")
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 3,
) -> None:
    """Write ``pages`` as archives below ``folder``; payloads under ``min_bytes`` are never revisits."""
    text = text_of(payload)
    total, volume = pages.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    # About SAMPLE_RECORDS rows, whatever the size of the table; the limit is for ids that repeat.
    share = F.lit(min(1 << 30, (SAMPLE_RECORDS << 30) // max(1, total)))
    sample = (
        pages.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < share)
        .select(F.substring(text, 1, SAMPLE_BYTES).alias("_text"))
        .limit(2 * SAMPLE_RECORDS)
        .collect()
    )
    samples = [record_bytes("0", None, _digest(b""), 0, r[0].encode()[:SAMPLE_BYTES], None, date) for r in sample]
    dictionary = train_dictionary(sorted(set(samples)))
    # Each file begins with the dictionary and ends when it has this many records.
    held = max(1, FILE_BYTES * total // max(1, (volume or 0) + 1024 * total))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level, dict_data=_as_dictionary(dictionary))
        written = 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if written % held == 0:
                    out.append(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                written += 1
                digest = base64.b32encode(bytes.fromhex(row["_sha"])).decode()
                data = record_bytes(row["_key"], row["_uri"], digest, row["_bytes"], row["_payload"], row["_refers"], date)
                out.append(compressor.compress(data))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    (
        archive_records(pages, key, uri, payload, min_bytes)
        .mapInArrow(frames, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", held + 1)
        .text(folder, compression="none", lineSep=EMPTY_FRAME)
    )


def read_frames(data: bytes) -> Iterator[bytes]:
    """The records of one archive."""
    view, at, plain = memoryview(data), 0, zstandard.ZstdDecompressor()
    step = 16 << 10  # what follows a frame is copied, so it is fed in small steps
    while at < len(view):
        magic = struct.unpack_from("<I", view, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + struct.unpack_from("<I", view, at + 4)[0]
            if magic == DICTIONARY_MAGIC:
                plain = zstandard.ZstdDecompressor(dict_data=_as_dictionary(bytes(view[at + 8 : end])))
            at = end
            continue
        reader, parts = plain.decompressobj(), []
        while not reader.eof:
            if at >= len(view):
                raise ValueError("archive ends inside a record")
            parts.append(reader.decompress(view[at : at + step]))
            at = min(at + step, len(view)) - len(reader.unused_data)
        yield b"".join(parts)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row of RECORD per record of the archives below ``folder``."""
    names = [part.split()[0] for part in RECORD.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                some: list[tuple] = []
                held = 0
                for record in read_frames(data.as_py()):
                    some.append(parse_record(record))
                    held += len(record)
                    if held > 8 << 20:
                        yield _batch(some, names, kinds)
                        some, held = [], 0
                yield _batch(some, names, kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(rows, RECORD)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)
