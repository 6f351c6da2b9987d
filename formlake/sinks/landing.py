"""``project_landing``: a sink that publishes whole chunks or nothing.

A task writes to files of its own under a staging folder. It holds back a chunk's rows until
the chunk's status row comes, and drops those of a chunk that failed. When every task has
ended, the driver moves the files of the tasks that count into the table; what killed or
repeated tasks have left goes with the staging folder, as does everything when the job fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import MapType, StructType

from formlake.sources.export_folder import filesystem
from formlake.sources.requests import KEY, STATUS, TOLD, Sink

FORMAT = "project_landing"
STAGING = "_staging"
HELD_BYTES = 32 << 20  # of a chunk in memory; beyond that it gets a file of its own
FAILED = "ERROR"


@dataclass
class Landed(WriterCommitMessage):
    """Files that a task has finished, by name in the staging folder."""

    files: list[str]


class _Files:
    """Files of one task; the common one holds all chunks that were small."""

    def __init__(self, store: fs.FileSystem, folder: str):
        self.store, self.folder, self.done = store, folder, []
        self.common: tuple[str, pq.ParquetWriter] | None = None

    def open(self, schema: pa.Schema) -> tuple[str, pq.ParquetWriter]:
        self.store.create_dir(self.folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.parquet"
        return name, pq.ParquetWriter(f"{self.folder}/{name}", schema, filesystem=self.store)

    def add(self, *batches: pa.RecordBatch) -> None:
        """Batches that are written together, so that they don't become a row group each."""
        if rows := [batch for batch in batches if batch.num_rows]:
            self.common = self.common or self.open(rows[0].schema)
            self.common[1].write_table(pa.Table.from_batches(rows))

    def drop(self, name: str) -> None:
        self.store.delete_file(f"{self.folder}/{name}")

    def close(self) -> list[str]:
        if self.common:
            self.common[1].close()
            self.done.append(self.common[0])
        return self.done


class _Chunk:
    """Rows of a chunk whose status is not known yet."""

    def __init__(self, files: _Files):
        self.files, self.held, self.size = files, [], 0
        self.own: tuple[str, pq.ParquetWriter] | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.size += batch.nbytes
        if self.size > HELD_BYTES:
            self.own = self.own or self.files.open(batch.schema)
            self.own[1].write_table(pa.Table.from_batches(self.held))
            self.held, self.size = [], 0

    def end(self, status: pa.RecordBatch) -> None:
        """Keep the rows or drop them; the status row lands in either case."""
        well = status.column(STATUS)[0].as_py() != FAILED
        if self.own:
            if self.held:
                self.own[1].write_table(pa.Table.from_batches(self.held))
            self.own[1].close()
            self.files.done.append(self.own[0]) if well else self.files.drop(self.own[0])
            self.files.add(status)
        else:
            self.files.add(*(self.held if well else ()), status)


def _without_empty_maps(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Empty maps become missing ones again."""
    cells, schema = list(batch.columns), batch.schema
    for at, column in enumerate(cells):
        if pa.types.is_map(column.type):
            filled = np.diff(column.offsets.to_numpy()) > 0
            if filled.any():
                cells[at] = pc.if_else(pa.array(filled), column, pa.scalar(None, column.type))
            else:
                cells[at] = pa.nulls(batch.num_rows, column.type)
            schema = schema.set(at, schema.field(at).with_nullable(True))
    return pa.RecordBatch.from_arrays(cells, schema=schema)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[bool, bool, pa.RecordBatch]]:
    """Rows that follow each other under one key: whether they have a key, are a status row, and they."""
    key, told = batch.column(KEY), pc.is_valid(batch.column(STATUS)).to_numpy(zero_copy_only=False)
    codes = pc.fill_null(key.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    bounds = np.flatnonzero(told[1:] | told[:-1] | (codes[1:] != codes[:-1])) + 1
    starts = [0, *bounds.tolist(), batch.num_rows] if batch.num_rows else []
    for start, end in zip(starts, starts[1:]):
        yield bool(codes[start] >= 0), bool(told[start]), batch.slice(start, end - start)


class LandingWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self._path, self._into = options["path"].rstrip("/"), options["into"]
        self._stage = f"{STAGING}/{uuid.uuid4().hex}"

    def _places(self) -> tuple[fs.FileSystem, str, str]:
        store, base = filesystem(self._path)
        return store, f"{base}/{self._stage}", f"{base}/{self._into}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Landed:
        store, stage, _ = self._places()
        files = _Files(store, stage)
        chunk: _Chunk | None = None
        for batch in iterator:
            for keyed, status, rows in _runs(_without_empty_maps(batch)):
                if not keyed:
                    files.add(rows)
                elif status:
                    (chunk or _Chunk(files)).end(rows)
                    chunk = None
                else:
                    chunk = chunk or _Chunk(files)
                    chunk.add(rows)
        if chunk is not None:
            raise RuntimeError("rows of a chunk without its status row")
        return Landed(files.close())

    def commit(self, messages: list) -> None:
        store, stage, table = self._places()
        store.create_dir(table, recursive=True)
        for message in messages:
            for name in message.files if message else ():
                store.move(f"{stage}/{name}", f"{table}/{name}")
        self._clear(store, stage)

    def abort(self, messages: list) -> None:
        store, stage, _ = self._places()
        self._clear(store, stage)

    def _clear(self, store: fs.FileSystem, stage: str) -> None:
        if store.get_file_info(stage).type == fs.FileType.Directory:
            store.delete_dir(stage)


class LandingTable(DataSource):
    """Options: ``path`` of a table and ``into``, the partition folder that rows go to."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> LandingWriter:
        return LandingWriter(dict(self.options))


def _with_empty_maps(rows: DataFrame) -> DataFrame:
    """Missing maps as empty ones, on their way to the sink's tasks.

    Spark asks for the size of an Arrow batch after each row, and Arrow then walks over all
    missing maps at the batch's end: time in the square of its rows.
    """
    maps = {f.name: f.dataType for f in rows.schema.fields if isinstance(f.dataType, MapType)}
    return rows.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.create_map().cast(kind)) for n, kind in maps.items()})


def land(rows: DataFrame, path: str, into: str) -> None:
    """Append rows and status rows to a Parquet table, chunks that failed without their rows.

    A chunk's rows follow each other in one task, and its status row follows them. Rows
    without a key land as they are. An empty map lands as a missing one.
    """
    rows.sparkSession.dataSource.register(LandingTable)
    _with_empty_maps(rows).write.format(FORMAT).options(path=path, into=into).mode("append").save()


def land_where_made(make: Callable[[Sink], DataFrame], path: str, into: str) -> None:
    """As ``land``, for rows that Python tasks make: these write them, and they don't pass through the JVM.

    ``make`` is given the sink for a task's batches, and returns the names that the sinks tell.
    """
    writer = LandingWriter({"path": path, "into": into})

    def sink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = writer.write(batches).files
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], names=[TOLD])

    try:
        told = make(sink).collect()  # a few files of each task, and only of tasks that count
        writer.commit([Landed([row[0] for row in told])])
    except BaseException:
        writer.abort([])
        raise
