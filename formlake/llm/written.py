"""Intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from formlake.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
