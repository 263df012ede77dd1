"""Sinks: JSONL files, the three-way routed output, rejects and packed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import GOOD_FIELDS


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """One JSON object per line, nulls kept, non-ASCII unescaped."""
    df.write.mode(mode).options(ignoreNullFields=False, **options).json(path)


def wrap_errors(df: DataFrame, column: str) -> DataFrame:
    """Bare texts as ``{"error": text}`` records."""
    return df.select(F.col(column).alias("error"))


def good_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("status") == "good").select(
        *[F.col(f"ticket.{name}").alias(name) for name in GOOD_FIELDS]
    )


def bad_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("status") == "bad").select("raw_ticket", "error", "error_class")


def transactions(routed: DataFrame, response: str = "response") -> DataFrame:
    """One row per answer that came back, including those later judged bad."""
    return routed.filter("answered").select(
        F.col("raw_ticket").alias("ticket_json"),
        "request_payload",
        F.col(response).alias("raw_response"),
    )


def write_routed(
    routed: DataFrame, folder: str, response: str = "response", mode: str = "errorifexists"
) -> None:
    """Good, bad and transaction files below ``folder``.

    The routed rows are written once as a columnar table and the three outputs
    read from it: the gates and any model step run once, and a lost executor
    costs a re-read instead of a re-run.
    """
    spark = routed.sparkSession
    routed.select(
        "status", "error_class", "error", "ticket", "raw_ticket", "request_payload", response, "answered"
    ).write.mode(mode).parquet(f"{folder}/routed")
    stored = spark.read.parquet(f"{folder}/routed")
    write_jsonl(good_rows(stored), f"{folder}/good", mode)
    write_jsonl(bad_rows(stored), f"{folder}/bad", mode)
    write_jsonl(transactions(stored, response), f"{folder}/transactions", mode)


# The layout of a packed project.
PACK_TITLE = "# Merged Python Project\n\n"
PACK_INTRO = "Below are all .py files in the project. Each file is wrapped in a code block.\n\n"

SHARD_BYTES = 128 * 1024 * 1024


def packed_section(path: Column, content: Column, language: str = "python") -> Column:
    return F.concat(
        F.lit("## File: "), path, F.lit(f"\n\n```{language}\n"), content, F.lit("\n```\n\n")
    )


def pack_shards(df: DataFrame, group: list[Column], order: Column, section: Column) -> DataFrame:
    """One packed text per group, sections in order.

    A group becomes one row, so its size must be bounded by how ``group`` is
    chosen (a range of ids, never a whole source).
    """
    listed = F.array_sort(F.collect_list(F.struct(order.alias("at"), section.alias("section"))))
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("files"),
        F.array_join(F.transform(listed, lambda x: x["section"]), "").alias("packed"),
    )


def write_packed(
    df: DataFrame, folder: str, path: str = "path", content: str = "content", shards: int | None = None
) -> None:
    """The whole corpus as text shards in path order, of about SHARD_BYTES unless ``shards`` is given.

    Range partitioning sorts without bringing a group together: the part files,
    read in name order, are the packed document. The title stands first.
    """
    spark: SparkSession = df.sparkSession
    sections = df.select(F.col(path).alias("path"), packed_section(F.col(path), F.col(content)).alias("value"))
    if shards is None:
        volume = sections.agg(F.sum(F.octet_length("value"))).first()[0] or 0
        shards = max(1, -(-volume // SHARD_BYTES))
    title = spark.createDataFrame([("", PACK_TITLE + PACK_INTRO)], "path string, value string")
    (
        title.unionByName(sections)
        .repartitionByRange(shards, "path")
        .sortWithinPartitions("path")
        # The text sink ends each value with a line feed, the last one of a section.
        .select(F.expr("left(value, length(value) - 1)").alias("value"))
        .write.mode("errorifexists").text(folder)
    )
