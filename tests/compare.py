"""Runs a query on Spark and its SQL on DuckDB and compares rows, names and types."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def _counted(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[list[str], int, float]:
    """What differs, the number of rows, and the seconds Spark took."""
    start = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    result = con.execute(sql)
    names, types = [d[0] for d in result.description], [str(d[1]) for d in result.description]
    expected = result.fetchall()

    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"], len(rows), seconds
    for column, kind in df.dtypes:
        want = SAME_TYPE.get(kind, kind.upper())
        if want != types[names.index(column)]:
            problems.append(f"{column}: {kind} against {types[names.index(column)]}")
    order = sorted(names)
    ours = _counted(rows, [df.columns.index(c) for c in order])
    theirs = _counted(expected, [names.index(c) for c in order])
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        problems.append(
            f"rows {len(rows)} against {len(expected)}; {order}; only Spark {list(only_ours)[:2]};"
            f" only SQL {list(only_theirs)[:2]}"
        )
    return problems, len(rows), seconds


def main(sf: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from eventpulse.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, queries, oracles, failed = duckdb_tables(sf_dir), entry.queries(), entry.oracle_sql(), 0
    for name in wanted or queries:
        try:
            problems, n, seconds = differences(spark, con, name, queries[name], oracles[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems, n, seconds = [f"{type(error).__name__}: {str(error)[:700]}"], -1, 0.0
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={n} {seconds:.2f}s {' | '.join(problems)}", flush=True)
    print(f"{failed} of {len(wanted or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]))
