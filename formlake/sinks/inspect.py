"""Describe a table's columns as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# SQL spelling of the types a record table can have.
SQL_NAMES = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
    "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "binary": "BLOB",
}


def sql_type(data_type: T.DataType) -> str:
    name = data_type.simpleString()
    return SQL_NAMES.get(name, name.upper())


def inspect(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability; read from the schema alone."""
    rows = [
        (i, f.name, sql_type(f.dataType), not f.nullable, None, False)
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "cid int, name string, type string, `notnull` boolean, dflt_value string, pk boolean",
    )
