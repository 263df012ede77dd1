"""Event time as a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(df: DataFrame, ts: Column) -> Column:
    """Microseconds since the epoch; a timestamp without a zone is read as UTC."""
    kind = df.select(ts).schema.fields[0].dataType
    if isinstance(kind, T.TimestampNTZType):
        ts = F.make_timestamp_ltz(
            F.year(ts),
            F.month(ts),
            F.day(ts),
            F.hour(ts),
            F.minute(ts),
            F.date_part(F.lit("SECOND"), ts),
            F.lit("UTC"),
        )
    return F.unix_micros(ts)


def with_event_time(df: DataFrame, name: str) -> DataFrame:
    """``name`` as the timestamp type that watermarks need."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return df.withColumn(name, F.timestamp_micros(epoch_micros(df, F.col(name))))
    return df
