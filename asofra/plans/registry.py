"""Queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapter import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None, dates: str = "") -> Callable[[Query], Query]:
    """Register a function under its name. Both sides return the columns
    listed in ``dates`` as text, which no client library converts."""
    names = dates.split()

    def add(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(spark, sf_dir).withColumns({n: F.col(n).cast("string") for n in names})

        QUERIES[function.__name__] = run
        if sql is not None:
            text = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)
            whole = with_tables(sql)
            SQL[function.__name__] = f"SELECT * REPLACE ({text}) FROM ({whole})" if names else whole
        return run

    return add
