"""Compare a Spark result with a DuckDB result: columns, row count and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

FAMILIES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "HUGEINT": "hugeint",
}


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def difference(spark_df, connection, sql: str) -> str | None:
    """What differs, or None."""
    result = connection.execute(sql)
    names = sorted(column[0] for column in result.description)
    kinds = {column[0]: FAMILIES.get(str(column[1]), str(column[1])) for column in result.description}
    if sorted(spark_df.columns) != names:
        return f"columns {sorted(spark_df.columns)} != {names}"
    wrong = {n: (t, kinds[n]) for n, t in spark_df.dtypes if t != kinds[n]}
    if wrong:
        return f"types {wrong}"
    place = [[column[0] for column in result.description].index(name) for name in names]
    theirs = sorted((tuple(_plain(row[i]) for i in place) for row in result.fetchall()), key=_key)
    ours = sorted((tuple(_plain(row[n]) for n in names) for row in spark_df.collect()), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{dict(zip(names, left))} != {dict(zip(names, right))}"
    return None
