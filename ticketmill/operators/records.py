"""Record-level checks over line tables: reformat, counts, integrity, rejects."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from ..functions.jsonl import json_verdict


def with_verdict(
    lines: DataFrame, column: str = "value", allow_nan: bool = True, strip_line: bool = True, dump: bool = True
) -> DataFrame:
    """Lines with their ``json`` verdict. Counting and integrity checks of whole
    files do not strip lines; reading and reformatting do. Only reformatting needs ``dump``."""
    return lines.withColumn("json", json_verdict(F.col(column), allow_nan, strip_line=strip_line, dump=dump))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("json.verdict") == "ok")


def reformat(
    lines: DataFrame, column: str = "value", observation: Observation | None = None
) -> DataFrame:
    """Valid lines, rewritten canonically. Counts go to ``observation`` in the same pass."""
    judged = with_verdict(lines, column)
    if observation is not None:
        judged = judged.observe(observation, *reformat_counts())
    return accepted(judged).withColumn(column, F.col("json.line")).drop("json")


def reformat_counts() -> list[Column]:
    """Counts of a reformat run: a blank line counts as invalid here."""
    ok = F.col("json.verdict") == "ok"
    return [
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(ok).alias("valid_lines"),
        F.count_if(~ok).alias("invalid_lines"),
    ]


def reformat_report(judged: DataFrame) -> DataFrame:
    return judged.agg(*reformat_counts())


def count_records(judged: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Valid and invalid records: a blank line is neither."""
    verdict = F.col("json.verdict")
    return judged.groupBy(*by).agg(
        F.count_if(verdict == "ok").alias("valid_records"),
        F.count_if(~verdict.isin("ok", "blank")).alias("invalid_records"),
    )


def integrity(judged: DataFrame, by: Iterable[str], line_no: Column) -> DataFrame:
    """Per file: does every non-blank line decode, and which is the first that does not?"""
    bad = ~F.col("json.verdict").isin("ok", "blank")
    return judged.groupBy(*by).agg(
        (F.count_if(bad) == 0).alias("is_valid"),
        F.min(F.when(bad, line_no)).alias("first_bad_line"),
    )


def objects(judged: DataFrame) -> DataFrame:
    """Records that are JSON objects."""
    return judged.filter((F.col("json.verdict") == "ok") & (F.col("json.kind") == "object"))


def rejects(judged: DataFrame, keep: Iterable[str], objects_only: bool = False) -> DataFrame:
    """The quarantine table: every line that is neither blank nor accepted, with a reason."""
    verdict = F.col("json.verdict")
    reason = F.when(~verdict.isin("ok", "blank"), F.col("json.reason"))
    if objects_only:
        not_object = (verdict == "ok") & (F.col("json.kind") != "object")
        reason = F.coalesce(reason, F.when(not_object, F.concat(F.lit("not an object: "), F.col("json.kind"))))
    return judged.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*keep, "reason")


def io_metrics(judged: DataFrame, column: str = "value", by: Iterable[str] = ()) -> DataFrame:
    """Bytes with their line ends, lines read (blank ones too) and decode errors."""
    return judged.groupBy(*by).agg(
        F.sum(F.octet_length(F.coalesce(F.col(column), F.lit(""))) + F.lit(1)).cast("bigint").alias("bytes_read"),
        F.count(F.lit(1)).alias("read_operations"),
        F.count_if(~F.col("json.verdict").isin("ok", "blank")).alias("error_count"),
    )
