"""Record IDs: distinct, pending, missing and extra, restricted to a list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.operators.lookup import attach
from formlake.session import materialise


def distinct_ids(df: DataFrame, record_id: str) -> DataFrame:
    """Each record ID once; duplicates combine before the shuffle."""
    return df.select(record_id).filter(F.col(record_id).isNotNull()).distinct()


def pending_ids(source_ids: DataFrame, landed_ids: DataFrame, record_id: str) -> DataFrame:
    """Source IDs that have not landed yet. Both sides are distinct before they meet."""
    return distinct_ids(source_ids, record_id).join(
        distinct_ids(landed_ids, record_id), record_id, "left_anti"
    )


def missing_and_extra(source_ids: DataFrame, landed_ids: DataFrame, record_id: str) -> DataFrame:
    """IDs only in the source (``missing``) and only in the landed table (``extra``)."""
    source = distinct_ids(source_ids, record_id).withColumn("_in_source", F.lit(True))
    landed = distinct_ids(landed_ids, record_id).withColumn("_in_landed", F.lit(True))
    both = source.join(landed, record_id, "full")
    return both.filter("_in_source IS NULL OR _in_landed IS NULL").select(
        record_id, F.when(F.col("_in_source"), "missing").otherwise("extra").alias("kind")
    )


def restrict_to_ids(df: DataFrame, ids: DataFrame, record_id: str) -> DataFrame:
    """Rows of the listed IDs, each row once however often its ID is listed."""
    return attach(df, materialise(distinct_ids(ids, record_id)), [record_id], "left_semi")
