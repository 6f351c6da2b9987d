"""Means of doubles that don't depend on the order of addition.

A double is a whole number times a power of two. Cut by that power into buckets of 32 bits,
and each bucket's whole numbers into two halves, doubles add up without rounding as
decimals, in any order and on any number of partitions. One rounding follows, of the exact
sum divided by the count.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = 32  # bits
_HALF = 43  # bits of the lower half; the upper one then has at most 44
_PARTS = "_parts"


def _halves(value: Column) -> tuple[Column, Column, Column]:
    """Bucket, upper and lower half of a finite double; value = (upper * 2^43 + lower) * 2^(32 * bucket)."""
    # One bit lower than the last one of 53, as the logarithm may be rounded up.
    last = F.floor(F.log2(F.abs(value))) - 53
    bucket = F.when(value == 0, F.lit(0)).otherwise(F.floor(last / _BUCKET)).cast("int")
    # Powers of two are exact; two factors, as one would leave the range of a double.
    step = F.pow(F.lit(2.0), -bucket * (_BUCKET // 2))
    whole = value * step * step
    upper = F.floor(whole / float(1 << _HALF))
    lower = whole - upper.cast("double") * float(1 << _HALF)
    return bucket, upper.cast("decimal(20,0)"), lower.cast("bigint").cast("decimal(20,0)")


def rounded_mean(parts: list[dict], count: int) -> float:
    """The double next to the exact mean."""
    total = Fraction(0)
    for part in parts:
        total += (int(part["upper"]) * (1 << _HALF) + int(part["lower"])) * Fraction(2) ** (_BUCKET * part["bucket"])
    return float(total / count)


def _means(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for parts, counts in columns:
        pairs = zip(parts.to_pylist(), counts.to_pylist())
        yield pa.array([rounded_mean(p, n) if n else None for p, n in pairs], pa.float64())


_means.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def exact_mean(df: DataFrame, by: list[str], value: str, name: str = "mean") -> DataFrame:
    """Mean of each group, missing values ignored; null where there are none.

    Rows combine map-side by group and bucket; a group has at most some seventy buckets. NaN
    and infinities count as in any sum of doubles. Decimals keep their own exact mean.
    """
    if isinstance(df.schema[value].dataType, T.DecimalType):
        return df.groupBy(*by).agg(F.avg(value).alias(name))
    cell = F.col(f"`{value}`").cast("double")
    endless = F.lit(float("inf"))
    finite = cell.isNotNull() & ~F.isnan(cell) & (F.abs(cell) < endless)
    bucket, upper, lower = _halves(F.when(finite, cell))
    odd = F.when(F.isnan(cell), F.lit("nan")).when(cell == endless, F.lit("up")).when(cell == -endless, F.lit("down"))
    keys = [F.col(f"`{k}`").alias(f"_by{i}") for i, k in enumerate(by)]
    names = [f"_by{i}" for i in range(len(by))]
    cut = df.select(*keys, bucket.alias("bucket"), upper.alias("upper"), lower.alias("lower"), odd.alias("odd"))
    parts = cut.groupBy(*names, "bucket", "odd").agg(
        F.sum("upper").alias("upper"), F.sum("lower").alias("lower"), F.count("upper").alias("n")
    )
    part = F.struct("bucket", "upper", "lower")
    whole = parts.groupBy(*names).agg(
        F.collect_list(F.when(F.col("bucket").isNotNull(), part)).alias(_PARTS),
        F.sum("n").alias("n"),
        F.max(F.when(F.col("odd") == "nan", True)).alias("nan"),
        F.max(F.when(F.col("odd") == "up", True)).alias("up"),
        F.max(F.when(F.col("odd") == "down", True)).alias("down"),
    )
    mean = F.arrow_udf(_means, "double")(F.col(_PARTS), F.col("n"))
    mean = (
        F.when(F.col("nan") | (F.col("up") & F.col("down")), F.lit(float("nan")))
        .when(F.col("up"), endless)
        .when(F.col("down"), -endless)
        .otherwise(mean)
    )
    return whole.select(*[F.col(n).alias(k) for n, k in zip(names, by)], mean.alias(name))
