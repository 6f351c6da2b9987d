"""Choice lists written as ``"1, Yes | 0, No"``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANK = " \t\r\n"


def parse_choices(text: Column) -> Column:
    """``array<struct<code,label>>`` in written order; NULL when no item has a comma.

    An item splits at its first comma, so labels may hold further commas.
    """
    items = F.filter(F.split(text, r"\s*\|\s*"), lambda item: F.contains(item, F.lit(",")))

    def pair(item: Column) -> Column:
        after = F.substr(item, F.instr(item, ",") + 1)
        return F.struct(
            F.trim(F.substring_index(item, ",", 1), F.lit(_BLANK)).alias("code"),
            F.trim(after, F.lit(_BLANK)).alias("label"),
        )

    pairs = F.transform(items, pair)
    return F.when(F.size(pairs) > 0, pairs)


def choice_label(choices: Column, code: Column) -> Column:
    """Label of the first choice with this code, NULL when there is none."""
    return F.get(F.filter(choices, lambda c: c["code"] == code), F.lit(0))["label"]


def choices_map(choices: Column) -> Column:
    """``map<code,label>``; the first of several equal codes wins."""
    first_only = F.filter(
        choices,
        lambda c, i: F.array_position(F.transform(choices, lambda x: x["code"]), c["code"]) == i + 1,
    )
    return F.map_from_entries(first_only)


def choice_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per choice: the kept columns, 1-based position, code and label."""
    return (
        df.select(*keep, F.posexplode(parse_choices(F.col(text))).alias("_at", "_choice"))
        .select(
            *keep,
            (F.col("_at") + 1).alias("position"),
            F.col("_choice.code").alias("code"),
            F.col("_choice.label").alias("label"),
        )
    )
