"""Attach a one-row-per-key table to every row of a large DataFrame.

The keyed side is broadcast only after its rows and bytes have been counted.
Beyond that bound the join shuffles, and keys that hold a large share of the
rows are spread over salted copies so that no task receives a whole hot group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.session import materialise

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def _holds_map(kind: T.DataType) -> bool:
    """Maps can't be hashed, wherever in a type they are."""
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def row_spread(df: DataFrame) -> Column:
    """A number that differs between rows, and between equal rows of different partitions.

    It does not depend on the order of rows, so a task that is run again gives the same.
    """
    fields = [f for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in fields], F.spark_partition_id())


def sort_spread(df: DataFrame, *keys: Column) -> DataFrame:
    """Sort so that rows with equal keys can be split over partitions."""
    return df.withColumn("_tie", row_spread(df)).orderBy(*keys, "_tie").drop("_tie")


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure whether ``df`` holds at most this many rows and bytes."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`"))))
        else:
            width = width + 16
    seen = df.select(width.alias("w")).limit(rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("b")
    ).first()
    return seen["n"] <= rows and seen["b"] <= size


def hot_keys(df: DataFrame, on: list[str], per_partition: int = 4) -> DataFrame:
    """Keys holding more than 1/(4P) of the rows, P being the shuffle partitions, with ``_salts``.

    By counting, fewer than 4P keys can do so, which bounds the result. The count combines
    before its shuffle, so hot keys do not skew it, and only the hot ones are written. A
    key gets as many salts as it has partitions' worth of rows, so that a salted task holds
    about as much as any other; all salts together are fewer than 5P.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    counts = df.groupBy(*on).agg(F.count("*").alias("_n"))
    hot = counts.filter(F.col("_n") > max(total / (parts * per_partition), 1))
    salts = F.ceil(F.col("_n") * parts / F.lit(max(total, 1))).cast("int")
    return materialise(hot.select(*on, salts.alias("_salts")))


def attach(
    df: DataFrame,
    keyed: DataFrame,
    on: list[str],
    how: str = "left",
    rows: int = BROADCAST_ROWS,
    size: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``keyed`` (unique on ``on``) to ``df``; equal NULL keys match.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``.
    """
    names = [f"_key{i}" for i in range(len(on))]
    right = keyed.select(
        *[F.col(k).alias(n) for k, n in zip(on, names)],
        *[c for c in keyed.columns if c not in on],
    )

    def same(left_names: list[str], right_names: list[str]):
        return reduce(
            lambda a, b: a & b,
            [F.col(l).eqNullSafe(F.col(r)) for l, r in zip(left_names, right_names)],
        )

    if fits_broadcast(right, rows, size):
        joined = df.join(F.broadcast(right), same(on, names), how)
        return joined.drop(*names)

    hot = hot_keys(df, on).select(
        *[F.col(k).alias(f"_hot{i}") for i, k in enumerate(on)], "_salts"
    )
    hot_names = [f"_hot{i}" for i in range(len(on))]
    salts = F.coalesce("_salts", F.lit(1))
    # Fewer than 4P rows of keys.
    left = (
        df.join(F.broadcast(hot), same(on, hot_names), "left")
        .withColumn("_salt", F.pmod(row_spread(df), salts).cast("int"))
        .drop("_salts", *hot_names)
    )
    salted = (
        right.join(F.broadcast(hot), same(names, hot_names), "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts", *hot_names)
    )
    joined = left.join(salted, same(on, names) & (F.col("_salt") == F.col("_copy")), how)
    return joined.drop("_salt", "_copy", *names)
