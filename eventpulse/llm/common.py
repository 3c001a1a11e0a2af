"""What the operators share: the list of queries, reading a table, and cutting lineage in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, share_package, work_dir  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BATCH_ROWS = 1_000
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

# Words are runs of anything but these white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """List a function as a query, with the SQL it is compared with if there is any."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(df: DataFrame) -> SparkSession:
    """Has Arrow hand over ``BATCH_ROWS`` rows at a time: texts are long, and a batch lies in memory several times.

    A number that the session was given otherwise than by default is left as it is.
    """
    spark = df.sparkSession
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    return spark


_of_worker: dict[tuple, object] = {}


def kept_by_worker(name: tuple, make: Callable[[], object]) -> object:
    """What a Python worker has made under this name. It keeps one thing only, so what another operator left goes."""
    if name not in _of_worker:
        _of_worker.clear()
        _of_worker[name] = make()
    return _of_worker[name]


def written(df: DataFrame, name: str, folder: str | None = None, **options) -> DataFrame:
    """The rows written as Parquet to a new shared folder and read back from there."""
    path = folder or work_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
