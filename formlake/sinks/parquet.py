"""Parquet export and published views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_parquet(df: DataFrame, path: str, single_file: bool = False, mode: str = "error") -> None:
    """Write a table; label metadata is kept in the files' schema.

    ``single_file`` gathers the output in one task, for small results only.
    """
    (df.coalesce(1) if single_file else df).write.mode(mode).parquet(path)


def save_query(spark: SparkSession, query: str, path: str, **options) -> None:
    """Write the result of a SQL query."""
    save_parquet(spark.sql(query), path, **options)


def publish_views(forms: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Register each form's table as a temporary view; returns the names."""
    names = []
    for form, df in forms.items():
        df.createOrReplaceTempView(prefix + form)
        names.append(prefix + form)
    return names
