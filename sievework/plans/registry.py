"""Where the query modules of this package enter their queries, each with the SQL that gives the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Enters a function under its own name."""

    def enter(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return enter
