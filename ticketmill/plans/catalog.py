"""All registered queries by name, with the comparison SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import curation, monitoring, records, redaction, sequences, sources, streams

_MODULES = (redaction, records, curation, monitoring, sequences, streams, sources)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
