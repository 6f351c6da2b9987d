"""``project_export``: a Python data source over a folder of CSV exports.

Files need not share a header: columns are matched by name and absent ones are
missing. With ``mode=isolate`` a file that cannot be read becomes a status row
instead of failing the job.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import LongType, StringType, StructField, StructType

from formlake.sources.csv_ranges import RANGE_BYTES, plan_slices, read_slices, slice_batches
from formlake.sources.csv_stream import HeaderError, align, csv_batches, read_header

FORMAT = "project_export"
FILE, STATUS, ERROR, ROWS = "_file", "_status", "_error", "_rows"
_SUFFIX = ".csv"
UNREADABLE = (OSError, pa.ArrowException, UnicodeError, HeaderError, csv.Error)
FEW_FILES = 16  # headers of no more than these are read without a Spark job
_RANGES = {
    GreaterThan: pc.greater,
    GreaterThanOrEqual: pc.greater_equal,
    LessThan: pc.less,
    LessThanOrEqual: pc.less_equal,
}
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


filesystem = _filesystem


def list_files(path: str) -> list[tuple[str, int]]:
    """CSV files under a folder (or the one file named) with their sizes, by name."""
    store, inner = _filesystem(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(inner, info.size or 0)]
    found = store.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(
        (f.path, f.size or 0)
        for f in found
        if f.type == fs.FileType.File
        and f.path.endswith(_SUFFIX)
        and not f.base_name.startswith(("_", "."))
    )


def _header_of(store: fs.FileSystem, path: str) -> list[str]:
    """Column names of one file; none if it can't be read."""
    try:
        with store.open_input_stream(path) as stream:
            return read_header(stream)
    except UNREADABLE:
        return []


def headers(path: str) -> list[tuple[str, int, list[str]]]:
    """Path, size and columns of every file, read one file after the other."""
    store, _ = _filesystem(path)
    return [(file, size, _header_of(store, file)) for file, size in list_files(path)]


def headers_in_tasks(spark, path: str) -> list[tuple[str, int, list[str]]]:
    """The same, with the files' headers read by Spark tasks; one row a file comes back."""
    files = list_files(path)
    if not files:
        return []

    def read(batches):
        store, _ = _filesystem(path)
        for batch in batches:
            numbers, paths = (c.to_pylist() for c in batch.columns)
            found = pa.array([_header_of(store, file) for file in paths], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), found], names=["file_no", "names"])

    listed = spark.createDataFrame([(i, file) for i, (file, _) in enumerate(files)], "file_no bigint, file string")
    spread = listed.repartition(min(len(files), 4 * spark.sparkContext.defaultParallelism))
    rows = spread.mapInArrow(read, "file_no bigint, names array<string>").collect()
    names = {row["file_no"]: list(row["names"]) for row in rows}
    return [(file, size, names[i]) for i, (file, size) in enumerate(files)]


def merged(files: list[tuple[str, int, list[str]]]) -> list[str]:
    """Columns of all files in order of first appearance."""
    return list(dict.fromkeys(name for _, _, names in files for name in names))


def merged_header(path: str) -> list[str]:
    return merged(headers(path))


def export_schema(names: list[str], mode: str) -> StructType:
    """All columns as text, and the control columns of ``isolate``."""
    out = [StructField(n, StringType()) for n in names]
    if mode == "isolate":
        out += [
            StructField(FILE, StringType()),
            StructField(STATUS, StringType()),
            StructField(ERROR, StringType()),
            StructField(ROWS, LongType()),
        ]
    return StructType(out)


@dataclass
class FilePack(InputPartition):
    """Files read by one task."""

    files: list


class ExportFolder(DataSource):
    """Options: ``path``, ``fields`` (comma-separated, default all), ``mode``
    (``failfast`` or ``isolate``), ``bytes_per_task``, ``smaller_than`` (bytes of the files to read)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        fields = self.options.get("fields")
        names = (
            [f.strip() for f in fields.split(",")] if fields else merged_header(self.options["path"])
        )
        return export_schema(names, self.options.get("mode", "failfast"))

    def reader(self, schema: StructType) -> "ExportFolderReader":
        options = dict(self.options)
        if options.get("push", "false") == "true":
            return FilteringReader(schema, options)
        return ExportFolderReader(schema, options)


class ExportFolderReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self._path = options["path"]
        self._isolate = options.get("mode", "failfast") == "isolate"
        self._limit = int(options.get("bytes_per_task", 64 << 20))
        self._below = int(options.get("smaller_than", 0))
        self._columns = [
            f.name for f in schema.fields if f.name not in (FILE, STATUS, ERROR, ROWS)
        ]
        self._tests: list = []

    def partitions(self) -> list[InputPartition]:
        packs: list[FilePack] = []
        room = 0
        store, _ = _filesystem(self._path)
        for path, size in list_files(self._path):
            if self._below and size >= self._below and _header_of(store, path):
                continue  # others read its slices
            if not packs or size > room:
                packs.append(FilePack([]))
                room = self._limit
            packs[-1].files.append(path)
            room -= size
        return packs

    def _kept(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        for f in self._tests:
            names = batch.schema.names
            cells = (
                batch.column(names.index(f.attribute[0]))
                if f.attribute[0] in names
                else pa.nulls(batch.num_rows, pa.string())
            )
            if isinstance(f, IsNull):
                mask = pc.is_null(cells)
            elif isinstance(f, IsNotNull):
                mask = pc.is_valid(cells)
            elif type(f) in _RANGES:  # both sides compare text by its bytes
                mask = pc.fill_null(_RANGES[type(f)](cells, pa.scalar(f.value, pa.string())), False)
            else:
                values = list(f.value) if isinstance(f, In) else [f.value]
                mask = pc.is_in(cells, value_set=pa.array(values, pa.string()))
                mask = pc.and_(mask, pc.is_valid(cells))
            batch = batch.filter(mask)
        return batch

    def read(self, partition: FilePack | None):
        store, _ = _filesystem(self._path)
        for path in partition.files if partition else ():  # none where all files are cut
            yield from self.rows_of(path, lambda notes, p=path: self._whole(store, p, notes))

    def _whole(self, store: fs.FileSystem, path: str, notes: Counter) -> Iterator[pa.RecordBatch]:
        with store.open_input_stream(path) as stream:
            yield from csv_batches(stream, self._columns, notes=notes)

    def read_slice(self, part: dict) -> Iterator[pa.RecordBatch]:
        """Rows of a slice of a file; in isolate mode each slice has a status row."""
        store, _ = _filesystem(self._path)
        place = (store, part["file"], part["names"], part["begin"], part["end"], self._columns)
        yield from self.rows_of(part["file"], lambda notes: slice_batches(*place, notes))

    def rows_of(self, path: str, batches) -> Iterator[pa.RecordBatch]:
        rows, notes = 0, Counter()
        try:
            for batch in batches(notes):
                batch = self._kept(batch)
                rows += batch.num_rows
                if batch.num_rows:
                    yield self._out(align(batch, self._columns), batch.num_rows, path)
            status, error = ("SUCCESS", None) if rows else ("ERROR", "returned no data")
        except UNREADABLE as e:
            if not self._isolate:
                raise
            status, error = "ERROR", f"{type(e).__name__}: {e}"
        if self._isolate:
            if status == "SUCCESS" and notes:
                error = ", ".join(f"{n} {what}" for what, n in notes.items())
            yield self._status(path, status, error, rows)

    def _out(self, cells: list, n: int, path: str) -> pa.RecordBatch:
        names = list(self._columns)
        if self._isolate:
            text = pa.string()
            cells = [*cells, pa.array([path] * n, text), pa.nulls(n, text), pa.nulls(n, text),
                     pa.nulls(n, pa.int64())]
            names += [FILE, STATUS, ERROR, ROWS]
        return pa.RecordBatch.from_arrays(cells, names=names)

    def _status(self, path: str, status: str, error: str | None, rows: int) -> pa.RecordBatch:
        text = pa.string()
        cells = [pa.nulls(1, text) for _ in self._columns]
        cells += [
            pa.array([path], text),
            pa.array([status], text),
            pa.array([error], text),
            pa.array([rows], pa.int64()),
        ]
        names = [*self._columns, FILE, STATUS, ERROR, ROWS]
        return pa.RecordBatch.from_arrays(cells, names=names)


class FilteringReader(ExportFolderReader):
    """Reader for sessions that let Python data sources take filters."""

    def pushFilters(self, filters: list):
        """Take comparisons on text columns; Spark keeps the rest.

        In isolate mode nothing is taken, so that status rows reach Spark.
        """
        for f in filters:
            attribute = getattr(f, "attribute", ())
            known = not self._isolate and len(attribute) == 1 and attribute[0] in self._columns
            if known and isinstance(f, (EqualTo, In, IsNotNull, IsNull, *_RANGES)):
                self._tests.append(f)
            else:
                yield f


@dataclass
class FolderPlan:
    """The files of a folder with their columns, and the slices of the large ones."""

    files: list[tuple[str, int, list[str]]]
    range_bytes: int
    slices: DataFrame | None


def plan_folder(spark, path: str, range_bytes: int = RANGE_BYTES) -> FolderPlan:
    """Read headers, and cut files of more than ``range_bytes`` into slices."""
    few = len(list_files(path)) <= FEW_FILES
    files = headers(path) if few else headers_in_tasks(spark, path)
    large = [f for f in files if f[1] >= range_bytes and f[2]]
    slices = plan_slices(spark, large, lambda: _filesystem(path)[0], range_bytes) if large else None
    return FolderPlan(files, range_bytes, slices)


def read_folder(spark, path: str, plan: FolderPlan | None = None, range_bytes: int = RANGE_BYTES, **options):
    """All CSV exports under a folder as one all-text DataFrame.

    Files of more than ``range_bytes`` are read in slices by many tasks, whatever line breaks
    their cells hold. ``plan`` is what ``plan_folder`` found, where a folder is read often.
    """
    spark.dataSource.register(ExportFolder)
    options.setdefault("push", spark.conf.get(_PUSHDOWN, "false"))
    plan = plan or plan_folder(spark, path, range_bytes)
    fields = options.get("fields")
    names = [f.strip() for f in fields.split(",")] if fields else merged(plan.files)
    schema = export_schema(names, options.get("mode", "failfast"))
    if plan.slices is not None:
        options["smaller_than"] = str(plan.range_bytes)
    reader = spark.read.format(FORMAT).options(path=path, **options)
    rows = (reader if fields else reader.schema(schema)).load()
    if plan.slices is None:
        return rows
    large = ExportFolderReader(schema, {**options, "path": path})
    return rows.unionByName(read_slices(plan.slices, large.read_slice, schema))
