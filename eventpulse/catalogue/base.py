"""The list of queries and helpers to write them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import share_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """List a function as a query, with the SQL it is compared with if there is any."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is listed twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_round(expression: str, places: int) -> str:
    """SQL text of ``round_half_away``."""
    scale = f"{10**places}.0e0"
    return f"sign({expression}) * floor(abs({expression}) * {scale} + 0.5e0) / {scale}"
