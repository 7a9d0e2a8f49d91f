"""All queries of the library outside the optional subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tesserix.queries import extraction, extraction_sql, problems, spine

flagship = extraction.flagship


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (*problems.QUERIES, *extraction.QUERIES, *spine.QUERIES)}


def oracle_sql() -> dict[str, str]:
    return problems.ORACLE | extraction_sql.ORACLE | spine.ORACLE
