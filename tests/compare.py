"""Compare registered queries with their SQL twins.

Run as a script: ``python tests/compare.py <test-data folder> [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/**/*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return connection


def _canonical(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    if isinstance(value, float):
        return ("double", repr(value))
    return (type(value).__name__, repr(value))


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(row[i]) for i in order) for row in rows)


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def type_difference(df, connection, sql: str) -> str | None:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected = {row[0]: row[1] for row in described}
    actual = {name: SPARK_TYPES.get(kind, kind.upper()) for name, kind in df.dtypes}
    wrong = {n: (actual.get(n), k) for n, k in expected.items() if actual.get(n) != k}
    return f"types {wrong}" if wrong else None


def difference(df, connection, sql: str) -> str | None:
    """None when both sides have the same columns and rows."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return type_difference(df, connection, sql)
    extra = [row for row in actual if row not in set(expected)][:2]
    missing = [row for row in expected if row not in set(actual)][:2]
    return f"{len(actual)} rows != {len(expected)}\n  spark  {extra}\n  oracle {missing}"


def main() -> int:
    import __spark_entry__ as entry_module
    from riskflow import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    }
    spark = build_session("compare", "local[8]", **local)
    spark.sparkContext.setLogLevel("OFF")
    oracles, failed = entry_module.oracle_sql(), 0
    for name, run in entry_module.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            found = difference(run(spark, sf_dir), open_oracle(sf_dir), oracles[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        failed += found is not None
        print(f"{name:34s} {time.time() - started:6.2f}s {found or 'ok'}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
