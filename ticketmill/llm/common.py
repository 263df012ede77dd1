"""Reading tables, cutting lineage and joining on hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_folder

# A key counts as hot when it holds more than this share of the rows, so there are
# at most 1 / HOT_SHARE hot keys whatever the size of the table.
HOT_SHARE = 1 / 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows written below the folder of ``spark.checkpoint.dir`` and read again.

    Cuts the lineage: what follows survives lost executors without recomputing
    what came before. The folders are one per call and belong to the run; remove
    them with the run's folder.
    """
    folder = run_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def text_of(column: Column | str) -> Column:
    """The text; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``keyed`` (one row a key, ``size`` its number of rows) on ``key``.

    Keys that hold more than HOT_SHARE of ``total`` rows are at most 1 / HOT_SHARE
    many; they are sent to all tasks, so their rows are joined where they lie. Only
    the other keys are shuffled.
    """
    hot = keyed.filter(F.col(size) > F.lit(max(1.0, total * HOT_SHARE)))
    hot_keys = hot.select(F.col(key), F.lit(True).alias("_hot"))
    marked = rows.join(F.broadcast(hot_keys), key, "left")
    at_home = marked.filter("_hot").drop("_hot").join(F.broadcast(hot), key, "inner")
    cold = keyed.filter(F.col(size) <= F.lit(max(1.0, total * HOT_SHARE)))
    moved = marked.filter("_hot IS NULL").drop("_hot").join(cold, key, how)
    return at_home.unionByName(moved)
