"""Compare a Spark result with the DuckDB result of its SQL twin, ignoring row order."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    """Doubles have to agree to the last digit, and -0.0 is not 0.0."""
    return repr(float(value)) if isinstance(value, (Decimal, float)) else value


def difference(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description."""
    names = sorted(spark_frame.columns)
    result = connection.sql(sql)
    if names != sorted(result.columns):
        return f"columns {names} against {sorted(result.columns)}"
    picked = ", ".join(f'"{name}"' for name in names)
    expected = Counter(tuple(map(_plain, row)) for row in connection.sql(f"SELECT {picked} FROM ({sql})").fetchall())
    found = Counter(tuple(map(_plain, row)) for row in spark_frame.select(*[f"`{n}`" for n in names]).collect())
    if expected == found:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; "
        f"extra {list(extra)[:2]} missing {list(missing)[:2]} for {names}"
    )
