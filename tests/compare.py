"""Compare a Spark result with DuckDB's: columns, types by family, and all rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, Decimal)):
        return ("int", int(v)) if v == int(v) and not isinstance(v, Decimal) else ("dec", str(v))
    if isinstance(v, float):
        return ("float", "nan") if math.isnan(v) else ("float", v)
    if isinstance(v, datetime):
        return ("stamp", v.isoformat())
    if isinstance(v, date):
        return ("date", v.isoformat())
    return v


def _family(t: str) -> str:
    t = t.lower()
    if t in ("int", "integer", "bigint", "smallint", "tinyint", "hugeint"):
        return "int"
    if t in ("string", "varchar"):
        return "text"
    if t.startswith("timestamp"):
        return "timestamp"
    return t


def mismatch(df, con, sql: str) -> str | None:
    """None when both results agree, else what differs."""
    columns = sorted(df.columns)
    spark_types = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    relation = con.sql(sql)
    duck_types = {n: _family(str(t)) for n, t in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        return f"types: {spark_types} vs {duck_types}"
    spark_rows = Counter(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    at = [relation.columns.index(c) for c in columns]
    duck_rows = Counter(tuple(_cell(r[i]) for i in at) for r in relation.fetchall())
    if spark_rows == duck_rows:
        return None
    only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
    return (
        f"{sum(spark_rows.values())} vs {sum(duck_rows.values())} rows; columns {columns}; "
        f"only Spark {list(only_spark)[:2]}; only SQL {list(only_duck)[:2]}"
    )
