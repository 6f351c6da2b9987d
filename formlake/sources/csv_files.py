"""Spark's own CSV reader with every column landed as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.functions.text import clean_cell

# Reader options for exports (quotes doubled, line breaks inside quotes,
# every file's header checked against the columns).
CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "enforceSchema": "false",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
}


def land_text(df: DataFrame) -> DataFrame:
    """Trim cells and turn empty and ``NA`` cells into missing ones."""
    return df.select(*[clean_cell(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def read_csv_text(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV files that share one header.

    ``multiLine="false"`` lets Spark split large files whose cells hold no line breaks.
    """
    return land_text(spark.read.options(**{**CSV_OPTIONS, **options}).csv(path))


def append_aligned(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Append tables by column name; columns absent from one side are missing there."""
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first
