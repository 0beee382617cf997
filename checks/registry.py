"""Register a query and, beside it, the SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import Tables
from checks.tables_sql import with_tables

QUERIES: dict = {}


def digits(c):
    """The elements of an array to four digits, as text: every one of them is compared."""
    return F.array_join(F.transform(c, lambda e: F.round(e.cast("double") * 10000).cast("bigint").cast("string")), ",")


def digits_sql(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda e: cast(round(e::DOUBLE * 10000) AS BIGINT)), ',')"

ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark, sf_dir):
            return fn(Tables(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register
