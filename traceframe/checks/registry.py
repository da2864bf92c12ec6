from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all doubles, so that the order of additions does not show."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            (F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if kinds[c] in ("double", "float") else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
