"""Resumable streaming load of CSV exports dropped in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from formlake.sources.csv_files import CSV_OPTIONS, land_text


def stream_exports(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """New files of a folder as an all-text stream; files share one header."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return land_text(spark.readStream.options(**CSV_OPTIONS).schema(schema).csv(folder))


def land_available(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available now and stop; files loaded before are not read again."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table_path)
    )
    query.awaitTermination()
    return query
