"""A file-backed stand-in for an export service, over the given tables."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.operators.lookup import sort_spread
from formlake.operators.narrowing import as_text

GROUP_BYTES = 8 << 20  # of rows whose least and greatest ID are known
BATCH_ROWS = 1 << 14  # of an answer in memory

def write_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, by Spark's own file system."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = store.create(place, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def write_answers(records: DataFrame, record_id: str, path: str) -> tuple[str, str, list[str]]:
    """Records as text, in Parquet files in the order of their ID, so that a request opens its own rows only."""
    text = as_text(sort_spread(records, F.col(record_id).cast("string")))
    text.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return path, record_id, text.columns


class _Answer(io.RawIOBase):
    """A binary stream of pieces that are made as they are read."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self._pieces, self._held = pieces, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, room) -> int:
        while not self._held:
            piece = next(self._pieces, None)
            if piece is None:
                return 0
            self._held = memoryview(piece)
        n = min(len(room), len(self._held))
        room[:n], self._held = self._held[:n], self._held[n:]
        return n


class FileAnswers:
    """Answers requests from such files; with ``fail_every`` n, one request in n fails."""

    def __init__(self, answers: tuple[str, str, list[str]], fail_every: int = 0) -> None:
        self._path, self._record_id, self._columns = answers
        self._fail_every = fail_every

    def _scanner(self, columns: list[str], wanted: list[str] | None):
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(self._path) if ":" in self._path else (fs.LocalFileSystem(), self._path)
        chosen = None
        if wanted is not None:
            ident = ds.field(self._record_id)
            chosen = (ident >= min(wanted)) & (ident <= max(wanted)) & ident.isin(wanted)
        found = ds.dataset(inner, filesystem=store, format="parquet")
        return found.scanner(
            columns=columns, filter=chosen, batch_size=BATCH_ROWS, batch_readahead=2, fragment_readahead=1, use_threads=False
        )

    def _lines(self, columns: list[str], wanted: list[str] | None) -> Iterator[bytes]:
        """CSV text, the header first."""
        import pyarrow as pa
        import pyarrow.csv as pacsv

        scanner = self._scanner(columns, wanted)
        bare = pacsv.WriteOptions(include_header=False)
        out = io.BytesIO()
        pacsv.write_csv(pa.Table.from_batches([], scanner.projected_schema), out)
        yield out.getvalue()
        for batch in scanner.to_batches():
            if batch.num_rows:
                out = io.BytesIO()
                pacsv.write_csv(batch, out, bare)
                yield out.getvalue()

    def __call__(self, params):
        if params["content"] != "record":
            raise OSError("only records here")
        asked = params.get("records")
        if asked and "," in asked and self._fail_every and not zlib.crc32(asked.encode()) % self._fail_every:
            raise OSError("the service is busy")
        columns = [self._record_id] if asked is None else self._columns
        return io.BufferedReader(_Answer(self._lines(columns, None if asked is None else asked.split(","))), 1 << 20)
