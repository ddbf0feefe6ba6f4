"""Spark result against SQL result: same columns, same rows, whatever the order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], [types[i] for i in order], rows


def spark_rows(df: DataFrame) -> tuple[list[str], list[str], Counter]:
    names = sorted(df.columns)
    types = [df.schema[n].dataType.simpleString() for n in names]
    return names, types, Counter(tuple(row) for row in df.select(*names).collect())


SAME_TYPES = {
    "bigint": {"BIGINT", "NUMBER"},
    "int": {"INTEGER", "NUMBER"},
    "string": {"VARCHAR", "STRING"},
    "boolean": {"BOOLEAN", "bool"},
}


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    spark_names, spark_types, got = spark_rows(df)
    names, types, want = sql_rows(connection, sql)
    out = []
    if spark_names != names:
        return [f"columns {spark_names} against {names}"]
    for name, spark_type, sql_type in zip(names, spark_types, types):
        if sql_type not in SAME_TYPES.get(spark_type, {sql_type}):
            out.append(f"{name}: {spark_type} against {sql_type}")
    if got != want:
        out.append(f"{sum(got.values())} rows against {sum(want.values())}")
        out += [f"only Spark: {r}" for r in list((got - want))[:3]]
        out += [f"only SQL:   {r}" for r in list((want - got))[:3]]
    if not want:
        out.append("no rows at all")
    return out
