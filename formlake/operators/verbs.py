"""Row and column verbs on lazy record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.operators.dictionary import form_names, record_id_name
from formlake.operators.exact import exact_mean
from formlake.operators.lookup import attach, sort_spread
from formlake.session import materialise


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    """Keep rows where the condition holds; a NULL condition drops the row."""
    return df.filter(condition)


def select_fields(
    df: DataFrame,
    *fields: str,
    dictionary: DataFrame | None = None,
    keep_record_id: bool = False,
) -> DataFrame:
    """Select columns; on request put the record ID first when there are several forms."""
    wanted = list(fields)
    if keep_record_id:
        if dictionary is None:
            raise ValueError("keep_record_id needs the dictionary")
        record_id = record_id_name(dictionary)
        if record_id not in wanted and len(form_names(dictionary)) > 1:
            wanted.insert(0, record_id)
    return df.select(*wanted)


def arrange(df: DataFrame, *keys: str, descending: bool | list[bool] = False) -> DataFrame:
    """Sort with missing values last in either direction."""
    down = descending if isinstance(descending, list) else [descending] * len(keys)
    return sort_spread(
        df, *[F.desc_nulls_last(k) if d else F.asc_nulls_last(k) for k, d in zip(keys, down)]
    )


def group_mean(df: DataFrame, by: list[str], value: str, name: str = "mean") -> DataFrame:
    """Mean per group, missing values ignored; the same however the rows are partitioned."""
    return exact_mean(df, by, value, name)


def with_group_mean(df: DataFrame, by: list[str], value: str, name: str = "mean") -> DataFrame:
    """Put each group's mean beside its rows.

    Means are aggregated before the shuffle and attached by key, so a group that
    holds most of the rows is never gathered in one task as a window would do.
    """
    return attach(df, materialise(group_mean(df, by, value, name)), by)


def below_group_mean(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows whose value lies below the mean of their group."""
    return (
        with_group_mean(df, by, value, "_group_mean")
        .filter(F.col(value) < F.col("_group_mean"))
        .drop("_group_mean")
    )
