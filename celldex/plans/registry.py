"""Where plans enter their queries: by name, with the same in DuckDB SQL, or None where SQL can't express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None):
    def add(f):
        ALL[f.__name__] = (f, sql)
        return f

    return add
