"""Tables whose rows can be found again where they were read, without a shuffle.

Rows are written once, bucketed by the partition they came from. A later decision about
single rows comes back as one bitmap for each partition and meets them in place.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.session import scratch_path

PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
WORDS = "part int, words array<bigint>"


def pin(rows: DataFrame, name: str) -> DataFrame:
    """Write rows with their number ``row_no`` and partition ``part``, and read them back."""
    spark = rows.sparkSession
    rows = rows.withColumn("row_no", F.monotonically_increasing_id())
    rows = rows.withColumn("part", F.shiftright("row_no", PLACE_BITS).cast("int"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table, path = f"pinned_{uuid.uuid4().hex}", scratch_path(spark, name)
    rows.write.bucketBy(buckets, "part").option("path", path).format("parquet").saveAsTable(table)
    pinned = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: the files are where the path says
    return pinned


def bitmap(part: int, row_numbers: np.ndarray) -> pa.Table:
    """One row of ``WORDS`` with these rows of a partition marked."""
    places = row_numbers & ((1 << PLACE_BITS) - 1)
    bits = np.zeros((int(places.max()) // 64 + 1) * 64, np.uint8)
    bits[places] = 1
    words = np.packbits(bits, bitorder="little").view("<i8")
    return pa.table([pa.array([part], pa.int32()), pa.array([words], pa.list_(pa.int64()))], names=["part", "words"])


def bitmaps(marked: DataFrame) -> DataFrame:
    """``WORDS`` of the listed rows (part, row_no); a partition's numbers meet in one task."""

    def collect(table: pa.Table) -> pa.Table:
        return bitmap(table.column("part")[0].as_py(), table.column("row_no").to_numpy())

    return marked.select("part", "row_no").groupBy("part").applyInArrow(collect, WORDS)


def flagged(pinned: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """The pinned rows with a boolean column: whether the bitmaps mark them."""
    place = f"(row_no & {(1 << PLACE_BITS) - 1})"
    bit = f"shiftright(get(words, cast(shiftright({place}, 6) as int)), cast({place} & 63 as int)) & 1"
    joined = pinned.join(words.hint("shuffle_hash"), "part", "left")
    return joined.withColumn(name, F.expr(f"coalesce({bit}, 0) = 1")).drop("words")
