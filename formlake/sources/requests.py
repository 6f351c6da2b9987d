"""Run export requests inside Spark tasks, one chunk of record IDs or one day each."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import closing

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.sources.csv_stream import align, csv_batches
from formlake.sources.transport import Transport

# Columns beside the exported ones in a fetched table.
KEY, STATUS, ERROR, ROWS, SECONDS, EXTRA = (
    "_key", "_status", "_error", "_rows", "_seconds", "_extra",
)
CONTROL = [KEY, STATUS, ERROR, ROWS, SECONDS, EXTRA]
#: Takes a task's batches and gives batches of one text column, which tell what became of them.
Sink = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
TOLD = "_told"
TURN = "_turn"  # consecutive numbers of requests, where they have any
_ARROW = {
    KEY: pa.string(),
    STATUS: pa.string(),
    ERROR: pa.string(),
    ROWS: pa.int64(),
    SECONDS: pa.float64(),
    EXTRA: pa.map_(pa.string(), pa.string()),
}


def fetched_schema(columns: list[str]) -> T.StructType:
    return T.StructType(
        [
            *[T.StructField(c, T.StringType()) for c in columns],
            T.StructField(KEY, T.StringType()),
            T.StructField(STATUS, T.StringType()),
            T.StructField(ERROR, T.StringType()),
            T.StructField(ROWS, T.LongType()),
            T.StructField(SECONDS, T.DoubleType()),
            T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType())),
        ]
    )


def _extra_cells(batch: pa.RecordBatch, columns: list[str]) -> pa.Array:
    """Cells of columns the table does not know, as a map per row."""
    unknown = [n for n in batch.schema.names if n not in columns]
    if not unknown:
        return pa.nulls(batch.num_rows, _ARROW[EXTRA])
    cells = {n: batch.column(batch.schema.names.index(n)).to_pylist() for n in unknown}
    return pa.array(
        [[(n, cells[n][i]) for n in unknown] for i in range(batch.num_rows)], _ARROW[EXTRA]
    )


def _answer(
    key: str, params: dict, transport: Transport, columns: list[str], empty_is_error: bool
) -> Iterator[pa.RecordBatch]:
    """Rows of one request as they arrive, then one status row whatever happened."""
    names = [*columns, *CONTROL]
    started, rows, error = time.monotonic(), 0, None
    try:
        with closing(transport(params)) as stream:
            for batch in csv_batches(stream, ahead=True):
                n = batch.num_rows
                rows += n
                control = [
                    pa.repeat(pa.scalar(key, pa.string()), n),
                    *[pa.nulls(n, _ARROW[c]) for c in (STATUS, ERROR, ROWS, SECONDS)],
                    _extra_cells(batch, columns),
                ]
                yield pa.RecordBatch.from_arrays([*align(batch, columns), *control], names=names)
        if rows == 0 and empty_is_error:
            error = "returned no data"
    except Exception as e:  # a request's failure must not fail its neighbours
        error = f"{type(e).__name__}: {e}"
    control = [
        pa.array([key], pa.string()),
        pa.array(["ERROR" if error else "SUCCESS"], pa.string()),
        pa.array([error], pa.string()),
        pa.array([rows], pa.int64()),
        pa.array([time.monotonic() - started], pa.float64()),
        pa.nulls(1, _ARROW[EXTRA]),
    ]
    blank = [pa.nulls(1, pa.string()) for _ in columns]
    yield pa.RecordBatch.from_arrays([*blank, *control], names=names)


def run_requests(
    requests: DataFrame,
    transport: Transport,
    columns: list[str],
    parallel: int,
    empty_is_error: bool = True,
    sink: Sink | None = None,
) -> DataFrame:
    """Answer a table of requests (``_key``, ``params`` as a map) with their rows.

    Rows stream through the task; a failed request leaves a status row, and its
    partial rows carry its key so that readers can leave them out. With a ``sink`` they
    go to it in the task that asked, and what it tells is returned in their place.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _answer(
                    row[KEY], dict(row["params"]), transport, columns, empty_is_error
                )

    if TURN in requests.columns:  # exactly as many for each task; in a round each partition begins anywhere
        spread = requests.repartitionById(parallel, F.pmod(F.col(TURN), F.lit(parallel)).cast("int"))
    else:
        spread = requests.repartition(parallel)
    spread = spread.select(KEY, "params")
    if sink is None:
        return spread.mapInArrow(answer, fetched_schema(columns))
    return spread.mapInArrow(lambda batches: sink(answer(batches)), f"{TOLD} string")


def _counted(batch: pa.RecordBatch, column: str) -> pa.RecordBatch:
    """Each cell of a column once with its rows; a cell missing there comes from the first other column."""
    names = batch.schema.names
    wanted = [column] * (column in names) + [n for n in names if n != column][:1]
    values, counts = pc.value_counts(pc.coalesce(*[batch.column(n) for n in wanted])).flatten()
    return pa.RecordBatch.from_arrays([values, counts, pa.nulls(len(counts), pa.string())], names=[column, ROWS, ERROR])


def counted_cells(requests: DataFrame, transport: Transport, column: str) -> DataFrame:
    """Cells of a column in the answers to a few requests, with their rows; a failure fails the job.

    They are counted as they arrive, so that fewer of them leave the task; then all counts meet.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    with closing(transport(dict(row["params"]))) as stream:
                        for found in csv_batches(stream, ahead=True):
                            yield _counted(found, column)
                except Exception as e:
                    cells = [pa.nulls(1, pa.string()), pa.array([0], pa.int64()), pa.array([f"{type(e).__name__}: {e}"])]
                    yield pa.RecordBatch.from_arrays(cells, names=[column, ROWS, ERROR])

    schema = T.StructType(
        [T.StructField(column, T.StringType()), T.StructField(ROWS, T.LongType()), T.StructField(ERROR, T.StringType())]
    )
    found = requests.select("params").repartition(1).mapInArrow(answer, schema)
    failed = F.col(ERROR).isNotNull()
    found = found.filter(F.when(failed, F.raise_error(F.col(ERROR)).cast("boolean")).otherwise(True))
    cell = F.col(f"`{column}`")
    # Without the shuffle one task would group all cells, and hand them on in one partition.
    return found.repartition(cell).groupBy(cell).agg(F.sum(ROWS).alias("n_rows"))


def chunk_requests(chunks: DataFrame, record_id: str, params: dict[str, str]) -> DataFrame:
    """One request per chunk, its record IDs joined by commas.

    A chunk holds at most ``chunk_size`` IDs, so no group grows with the data.
    """
    fixed = [F.lit(x) for item in params.items() for x in item]
    ids = F.array_join(F.sort_array(F.collect_list(F.col(record_id).cast("string"))), ",")
    return (
        chunks.groupBy("chunk")
        .agg(ids.alias("_ids"))
        .select(
            F.col("chunk").cast("string").alias(KEY),
            F.col("chunk").alias(TURN),
            F.map_concat(
                F.create_map(*fixed), F.create_map(F.lit("records"), F.col("_ids"))
            ).alias("params"),
        )
    )


def day_requests(windows: DataFrame, params: dict[str, str]) -> DataFrame:
    """One request per day window."""
    fixed = [F.lit(x) for item in params.items() for x in item]

    def stamp(name: str):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")

    return windows.select(
        F.col("day").cast("string").alias(KEY),
        F.map_concat(
            F.create_map(*fixed),
            F.create_map(
                F.lit("beginTime"), stamp("begin_time"), F.lit("endTime"), stamp("end_time")
            ),
        ).alias("params"),
    )


def single_request(spark, params: dict[str, str]) -> DataFrame:
    cells = [F.lit(x) for item in params.items() for x in item]
    return spark.range(1).select(F.lit("all").alias(KEY), F.create_map(*cells).alias("params"))
