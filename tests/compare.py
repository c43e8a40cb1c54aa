"""Compare a Spark result with the same query in DuckDB, row for row."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return f"d{value:f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return f"f{value!r}"
    return value


def _kind(name: str) -> str:
    """Type family: widths may differ, families may not."""
    name = name.lower()
    if name.startswith("decimal"):
        return name.replace(" ", "")
    families = {
        "varchar": "string", "bigint": "int", "integer": "int", "hugeint": "hugeint",
        "int": "int", "long": "int", "timestamp_ntz": "timestamp",
    }
    return families.get(name, name)


def differences(spark_df, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: _kind(str(c[1])) for c in cursor.description}
    expected_rows = cursor.fetchall()
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: spark {sorted(spark_df.columns)} sql {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if _kind(kind) != kinds[name]:
            found.append(f"type of {name}: spark {kind} sql {kinds[name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    expected = Counter(tuple(plain(r[i]) for i in at) for r in expected_rows)
    actual = Counter(tuple(plain(r[n]) for n in order) for r in spark_df.collect())
    if expected != actual:
        only_spark, only_sql = actual - expected, expected - actual
        found.append(f"rows: spark {sum(actual.values())} sql {sum(expected.values())}; columns {order}")
        found.append(f"only spark ({sum(only_spark.values())}): {sorted(only_spark, key=repr)[:3]}")
        found.append(f"only sql ({sum(only_sql.values())}): {sorted(only_sql, key=repr)[:3]}")
    return found
