"""Large CSV files cut into byte ranges that are read by different tasks.

A range can't know whether it begins inside a quoted cell. A first pass therefore scans each
range for both cases: the marks in it, and where its first record would begin. The marks of
the ranges before, added up, say which case holds. A second pass parses the records between
one range's first record and the next one's. A file whose quotes don't enclose whole cells
can't be cut like this, which the scan sees; it stays in one piece.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formlake.session import materialise
from formlake.sources.csv_stream import BOM, QuoteScan, csv_batches

RANGE_BYTES = 64 << 20
_PIECE = 4 << 20

FILES = "file string, size bigint, names array<string>"
_SCANNED = (
    "file string, size bigint, names array<string>, no bigint, quotes bigint, "
    "start_outside bigint, start_inside bigint, sound_outside boolean, sound_inside boolean"
)
_SCANNED_ARROW = [
    pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(),
]
MAX_TASKS = 100_000
TASK_BYTES = 64 << 20  # of short ranges or slices that one task reads one after the other
_TASKS_A_CORE = 4


def scan_range(file: pa.NativeFile, size: int, begin: int, end: int) -> tuple:
    """Quotes in a range, where its first record begins, and whether its quotes enclose cells.

    The last two come twice: for a range that begins outside of quotes, and inside.
    """
    before = 10
    if begin:
        file.seek(begin - 1)
        before = file.read(1)[0]
    cases = [QuoteScan(inside, before) for inside in (False, True)]
    starts: list[int | None] = [None, None]
    file.seek(begin)
    at = begin
    quotes = 0
    while at < end:
        piece = file.read(min(_PIECE, end - at))
        if not piece:
            break
        quotes += piece.count(b'"')
        following = None
        if at + len(piece) >= end and end < size:
            following = file.read(1)[0]
        if not at and piece.startswith(BOM):
            piece = b"\n" * len(BOM) + piece[len(BOM) :]
        for i, case in enumerate(cases):
            ends = case.take(piece, following)
            if starts[i] is None and len(ends):
                starts[i] = at + int(ends[0])
        at += len(piece)
    return quotes, *starts, *(not case.faulty for case in cases)


def _scan(store_of: Callable[[], fs.FileSystem], range_bytes: int) -> Callable:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = store_of()
        for batch in batches:
            rows = []
            for file, size, names, no in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(file) as opened:
                    found = scan_range(opened, size, no * range_bytes, min(size, (no + 1) * range_bytes))
                rows.append((file, size, names, no, *found))
            names_ = [part.split()[0] for part in _SCANNED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _SCANNED_ARROW)], names=names_)

    return scan


def _spread(rows: DataFrame, size: Column) -> DataFrame:
    """Rows over all cores, and over more tasks where one would read more than ``TASK_BYTES``; one row may be larger."""
    seen = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(_TASKS_A_CORE * cores, -(-seen["bytes"] // TASK_BYTES))
    return rows.repartition(max(1, min(MAX_TASKS, seen["rows"], tasks)))


def plan_slices(
    spark: SparkSession,
    files: list[tuple[str, int, list[str]]],
    store_of: Callable[[], fs.FileSystem],
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """file, names, begin and end of slices that hold whole records; files are (path, size, columns).

    The first slice of a file holds its header.
    """
    listed = spark.createDataFrame(files, FILES)
    last = F.floor((F.col("size") - 1) / range_bytes).cast("bigint")
    ranges = listed.where("size > 0").select("file", "size", "names", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("no"))
    scanned = materialise(_spread(ranges, F.lit(range_bytes)).mapInArrow(_scan(store_of, range_bytes), _SCANNED))
    # One row a range: some ten thousand for a file of a terabyte.
    forwards = Window.partitionBy("file").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    backwards = Window.partitionBy("file").orderBy(F.desc("no")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    cases = scanned.withColumn("inside", F.coalesce(F.sum("quotes").over(forwards), F.lit(0)) % 2 == 1)
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}_inside")).otherwise(F.col(f"{name}_outside"))
    cases = cases.withColumn("start", F.when(F.col("no") == 0, F.lit(0)).otherwise(pick("start")))
    cases = cases.withColumn("sound", F.min(pick("sound")).over(whole))
    following = F.coalesce(F.last("start", ignorenulls=True).over(backwards), F.col("size"))
    cut = cases.withColumn("end", following).where("sound and start < end")
    slices = cut.select("file", "names", F.col("start").alias("begin"), "end")
    uncut = cases.where("not sound and no = 0").select("file", "names", F.lit(0).cast("bigint").alias("begin"), F.col("size").alias("end"))
    return materialise(slices.unionByName(uncut))


class _Part(io.RawIOBase):
    """The bytes of a file between two offsets."""

    def __init__(self, file: pa.NativeFile, begin: int, end: int):
        file.seek(begin)
        self._file, self._left = file, end - begin

    def read(self, size: int = -1) -> bytes:
        size = self._left if size < 0 else min(size, self._left)
        data = self._file.read(size) if size else b""
        self._left -= len(data)
        return data


def slice_batches(
    store: fs.FileSystem, file: str, names: list[str], begin: int, end: int, columns: list[str], notes: Counter
) -> Iterator[pa.RecordBatch]:
    """Cells of the records of a slice."""
    with store.open_input_file(file) as opened:
        yield from csv_batches(_Part(opened, begin, end), columns, names=names if begin else None, notes=notes)


def read_slices(slices: DataFrame, parse: Callable[[dict], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """What ``parse`` makes of each slice; a task takes short slices one after the other."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from parse(row)

    return _spread(slices, F.col("end") - F.col("begin")).mapInArrow(read, schema)
