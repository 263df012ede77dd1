"""Model calls through a ledger of answers, so that no answered request is sent again.

The ledger is a folder of small files, one for each batch of requests a task has sent,
written as soon as its answers are there and named by the requests in it. A run sends only
the distinct requests that the ledger lacks. A run that is killed leaves the answers it
got; a task that runs again reads the files of its finished batches in place of sending
them. Only the batch in flight may be sent twice.

Defined cases: null requests are not sent and have no answer; equal requests are sent
once; a call that fails with one of ``retry_on`` is tried again after growing waits, and
after the last attempt its error fails the task, with what was answered before kept.
"""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import run_folder
from ..sources.ranges import located
from .sequence import MAX_ATTEMPTS, MAX_WAIT, MIN_WAIT

BATCH = 1000
_SCHEMA = pa.schema([("hash", pa.string()), ("answer", pa.string())])
_COLUMNS = "hash string, answer string"


def attempted(
    call: Callable[[pd.Series], pd.Series],
    requests: pd.Series,
    retry_on: tuple[type[Exception], ...],
    attempts: int = MAX_ATTEMPTS,
    sleep: Callable[[float], None] = time.sleep,
) -> pd.Series:
    """Answers of a batch; waits double from MIN_WAIT to MAX_WAIT seconds, each cut at random."""
    for attempt in range(1, attempts + 1):
        try:
            return call(requests)
        except retry_on:
            if attempt == attempts:
                raise
            sleep(random.uniform(MIN_WAIT, min(MAX_WAIT, MIN_WAIT * 2**attempt)))
    raise ValueError("at least one attempt is needed")


def _answered(ledger: str, hashes: list[str], requests: list[str], send: Callable[[pd.Series], pd.Series]) -> list[str | None]:
    """Answers of a batch from its file, or from the model and then written to its file."""
    system, folder = located(ledger)
    name = f"{folder}/batch-{hashlib.sha256(''.join(hashes).encode()).hexdigest()}.parquet"
    if system.get_file_info(name).type == fs.FileType.File:
        known = pq.read_table(name, filesystem=system, schema=_SCHEMA)
        by_hash = dict(zip(known["hash"].to_pylist(), known["answer"].to_pylist(), strict=True))
        return [by_hash[h] for h in hashes]
    given = list(send(pd.Series(requests, dtype=object)))
    if len(given) != len(requests):
        raise ValueError(f"{len(given)} answers to {len(requests)} requests")
    staged = f"{folder}/_{name.rsplit('/', 1)[1]}.{random.getrandbits(64):x}"
    pq.write_table(pa.table([pa.array(hashes), pa.array(given, pa.string())], schema=_SCHEMA), staged, filesystem=system)
    system.move(staged, name)  # a file in place is whole
    return given


def _known(df: DataFrame, ledger: str) -> DataFrame:
    """All answers of a ledger; a hash that two batches hold counts once."""
    spark = df.sparkSession
    system, folder = located(ledger)
    system.create_dir(folder, recursive=True)
    return spark.read.schema(_COLUMNS).option("pathGlobFilter", "batch-*.parquet").parquet(ledger).groupBy("hash").agg(F.min("answer").alias("answer"))


def with_ledger(
    df: DataFrame,
    model_fn: Callable[[pd.Series], pd.Series],
    ledger: str,
    request: str = "request_payload",
    response: str = "response",
    batch: int = BATCH,
    retry_on: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
    attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """``df`` with the model's answers, sent or known from ``ledger``, a folder that runs share.

    The requests to send are stored first: a repeated task gets the same batches. Put
    `repartition` before it to set how many run at once.
    """
    digest = F.sha2(F.col(request).cast("string"), 256)
    asked = df.filter(F.col(request).isNotNull()).select(digest.alias("hash"), F.col(request).cast("string").alias("request"))
    asked = asked.groupBy("hash").agg(F.min("request").alias("request"))
    folder = run_folder(df.sparkSession, "requests")
    asked.join(_known(df, ledger).select("hash"), "hash", "left_anti").write.parquet(folder)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        for some in batches:
            for at in range(0, some.num_rows, batch):
                part = some.slice(at, batch)
                hashes, requests = (c.to_pylist() for c in part.columns)
                _answered(ledger, hashes, requests, lambda r: attempted(model_fn, r, retry_on, attempts))
                count += len(hashes)
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["sent"])

    todo = df.sparkSession.read.schema("hash string, request string").parquet(folder)
    todo.mapInArrow(send, "sent long").agg(F.sum("sent")).collect()
    answers = _known(df, ledger).withColumnsRenamed({"hash": "__hash", "answer": "__answer"})
    kept = [c for c in df.columns if c != response]
    found = df.withColumn("__key", digest).join(answers, F.col("__key") == F.col("__hash"), "left")
    return found.select(*kept, F.col("__answer").alias(response))
