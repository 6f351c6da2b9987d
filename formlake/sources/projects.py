"""Where a project's records, dictionary and audit log come from."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.operators.audit import audit_range, conform_audit, day_windows_between
from formlake.operators.columns import (
    blank_gray_status,
    filter_events,
    filter_logic,
    filter_modified,
    project_families,
    project_fields,
    project_forms,
)
from formlake.operators.dictionary import DICTIONARY_COLUMNS, conform
from formlake.operators.ids import restrict_to_ids
from formlake.operators.lookup import attach
from formlake.operators.narrowing import as_text
from formlake.session import materialise, spread_if_few
from formlake.sources.csv_ranges import RANGE_BYTES
from formlake.sources.csv_stream import read_header
from formlake.sources.export_folder import ERROR as FILE_ERROR
from formlake.sources.export_folder import FILE, plan_folder, read_folder
from formlake.sources.export_folder import STATUS as FILE_STATUS
from formlake.sources.requests import (
    CONTROL,
    ERROR,
    EXTRA,
    KEY,
    ROWS,
    STATUS,
    Sink,
    chunk_requests,
    counted_cells,
    day_requests,
    run_requests,
    single_request,
)
from formlake.sources.transport import (
    AUDIT_REQUEST,
    DICTIONARY_REQUEST,
    ExportOptions,
    Transport,
)

_FILE_CONTROL = (FILE, FILE_STATUS, FILE_ERROR, "_rows")


class TableSource:
    """Records that Spark can already read as a table."""

    reports_status = False
    wave_chunks = None  # one job: a table needs no requests

    def __init__(
        self,
        records: DataFrame,
        dictionary: DataFrame | None,
        record_id: str,
        audit: DataFrame | None = None,
        options: ExportOptions | None = None,
        modified_column: str | None = None,
    ) -> None:
        self._records, self._dictionary, self._audit = records, dictionary, audit
        self.record_id, self._options = record_id, options or ExportOptions()
        self._modified_column = modified_column

    def dictionary(self) -> DataFrame | None:
        return None if self._dictionary is None else conform(self._dictionary)

    def audit_log(self, begin: date, end: date) -> DataFrame | None:
        return None if self._audit is None else audit_range(conform_audit(self._audit), begin, end)

    def _chosen(self) -> DataFrame:
        """Rows the filters let through; columns are still whole."""
        o, df = self._options, filter_logic(self._records, self._options.filter_logic)
        if o.modified_after or o.modified_before:
            if self._modified_column is None:
                raise ValueError("a datetime range needs modified_column")
            df = filter_modified(df, self._modified_column, o.modified_after, o.modified_before)
        return filter_events(df, list(o.events)) if o.events else df

    def records(self) -> DataFrame:
        """The export: chosen rows, then the column families asked for."""
        o, df = self._options, self._chosen()
        dictionary = self.dictionary()
        if dictionary is None:
            return project_fields(df, list(o.fields), self.record_id) if o.fields else df
        if o.blank_for_gray_status:
            df = blank_gray_status(df, dictionary, self.record_id)
        if not (o.survey_fields and o.access_groups):
            df = project_families(df, dictionary, o.survey_fields, o.access_groups)
        if not o.fields and not o.forms:
            return df
        kept = {self.record_id}
        if o.forms:
            kept |= set(project_forms(df, dictionary, list(o.forms)).columns)
        if o.fields:
            kept |= set(project_fields(df, list(o.fields), self.record_id).columns)
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])

    def record_ids(self) -> DataFrame:
        """IDs as text; only the ID column and the filters' columns are read."""
        return self._chosen().select(F.col(self.record_id).cast("string").alias(self.record_id))

    def counted_ids(self, done: DataFrame | None = None) -> DataFrame:
        """Each ID once with its rows, the missing one too."""
        return self.record_ids().groupBy(self.record_id).agg(F.count("*").alias("n_rows"))

    def fetch(
        self,
        chunks: DataFrame,
        everything: bool,
        done: DataFrame | None = None,
        unlanded: DataFrame | None = None,
    ) -> DataFrame:
        """Rows of the chunks' IDs as text; a first load needs no join at all.

        Rows without an ID are left out.
        """
        rows = self.records().filter(F.col(f"`{self.record_id}`").isNotNull())
        rows = as_text(spread_if_few(rows))
        if not everything:
            rows = restrict_to_ids(rows, chunks, self.record_id)
        return rows.withColumns(
            {KEY: F.lit(None).cast("string"), STATUS: F.lit(None).cast("string")}
        )

    def faults(self) -> DataFrame | None:
        """Messages about parts of the source that could not be read."""
        return None


class FolderSource(TableSource):
    """A folder with CSV exports: ``records/``, ``metadata.csv`` and ``log/``.

    A file lands whole or not at all. Rows of a file that turns out unreadable half-way
    carry its name and are left out on reading, and a later run takes that file again.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        record_id: str,
        options: ExportOptions | None = None,
        modified_column: str | None = None,
        range_bytes: int = RANGE_BYTES,
    ) -> None:
        base = path.rstrip("/")
        self._spark, self._path = spark, f"{base}/records"
        self._plan = plan_folder(spark, self._path, range_bytes)
        self._all = read_folder(spark, self._path, self._plan, mode="isolate")
        records = self._all.filter(F.col(FILE_STATUS).isNull()).drop(*_FILE_CONTROL)
        dictionary = read_folder(spark, f"{base}/metadata.csv")
        try:
            audit = read_folder(spark, f"{base}/log")
        except Exception:  # an export without an audit log
            audit = None
        if audit is not None and not audit.columns:
            audit = None
        super().__init__(records, dictionary, record_id, audit, options, modified_column)

    def _narrow(self) -> DataFrame:
        """Rows with their file's name and only the columns that IDs and filters need."""
        o = self._options
        if o.filter_logic:  # may name any column
            return self._all
        wanted = {self.record_id}
        if o.events:
            wanted |= {c for c in self._all.columns if c.endswith("event_name")}
        if self._modified_column:
            wanted.add(self._modified_column)
        fields = ",".join(c for c in self._all.columns if c in wanted)
        return read_folder(self._spark, self._path, self._plan, mode="isolate", fields=fields)

    def _kept(self, rows: DataFrame) -> DataFrame:
        """The rows that this source's filters let through, with all their columns."""
        return TableSource(
            rows, None, self.record_id, options=self._options, modified_column=self._modified_column
        )._chosen()

    def counted_ids(self, done: DataFrame | None = None) -> DataFrame:
        """Each ID with its rows, and whether a file not among ``done`` holds any of them."""
        rows = self._kept(self._narrow().filter(F.col(FILE_STATUS).isNull()))
        rows = rows.select(F.col(self.record_id), F.col(FILE))
        if done is None:
            rows = rows.withColumn("_done", F.lit(None).cast("boolean"))
        else:
            known = done.select(F.col(KEY).alias(FILE), F.lit(True).alias("_done"))
            rows = attach(rows, known, [FILE])
        return rows.groupBy(self.record_id).agg(
            F.count("*").alias("n_rows"), F.max(F.col("_done").isNull()).alias("in_new_file")
        )

    def fetch(
        self,
        chunks: DataFrame,
        everything: bool,
        done: DataFrame | None = None,
        unlanded: DataFrame | None = None,
    ) -> DataFrame:
        """Rows of new files, rows of unlanded IDs, and the files' status rows, in one pass."""
        kept = as_text(self._kept_with_status(self._all))
        names = [c for c in kept.columns if c not in _FILE_CONTROL]
        rows = kept.select(
            *[F.col(f"`{c}`") for c in names],
            F.col(FILE).alias(KEY),
            F.col(FILE_STATUS).alias(STATUS),
            F.col(FILE_ERROR).alias(ERROR),
            F.col("_rows").cast("bigint").alias(ROWS),
        )
        named = F.col(f"`{self.record_id}`").isNotNull()
        if everything:
            return rows.filter(F.col(STATUS).isNotNull() | named)
        columns = rows.columns
        wanted = (chunks if unlanded is None else unlanded).select(
            F.col(self.record_id), F.lit(True).alias("_wanted")
        )
        rows = attach(rows, materialise(wanted), [self.record_id])
        if done is None:
            rows = rows.withColumn("_done", F.lit(None).cast("boolean"))
        else:
            rows = attach(rows, done.select(KEY, F.lit(True).alias("_done")), [KEY])
        new = F.col("_done").isNull()
        return rows.filter(
            F.col(STATUS).isNotNull() & (new | (F.col(STATUS) == "ERROR"))
            | F.col(STATUS).isNull() & named & (new | F.col("_wanted"))
        ).select(*[F.col(f"`{c}`") for c in columns])

    def _kept_with_status(self, rows: DataFrame) -> DataFrame:
        """The export's rows and columns, beside the status rows and the control columns."""
        status = rows.filter(F.col(FILE_STATUS).isNotNull())
        o = self._options
        if o.filter_logic or o.events or o.modified_after or o.modified_before:
            kept = self._kept(rows.filter(F.col(FILE_STATUS).isNull()))
            rows = kept.unionByName(status)
        shaped = TableSource(
            rows.drop(*_FILE_CONTROL), self._dictionary, self.record_id,
            options=replace(o, filter_logic="", events=(), modified_after=None, modified_before=None),
        ).records()
        if shaped.columns == [c for c in rows.columns if c not in _FILE_CONTROL] and not o.blank_for_gray_status:
            return rows
        whole = TableSource(
            rows, self._dictionary, self.record_id,
            options=replace(
                o, filter_logic="", events=(), modified_after=None, modified_before=None, fields=(), forms=(),
                survey_fields=True, access_groups=True,
            ),
        ).records()
        return whole.select(*[F.col(f"`{c}`") for c in [*shaped.columns, *_FILE_CONTROL]])

    def faults(self) -> DataFrame:
        """Messages about the files that can't be read now."""
        bad = self._narrow().filter(F.col(FILE_STATUS) == "ERROR")
        return bad.select(
            F.concat(F.lit("Unable to read "), F.col(FILE), F.lit(": "), F.col(FILE_ERROR)).alias(
                "message"
            )
        )


class RequestSource:
    """Records behind an export service, asked for in chunks of record IDs.

    ``parallel`` bounds the requests in flight. Chunks land in waves of ``per_task``
    requests for each task, so a lost job or task asks only for few of them again.
    """

    reports_status = True
    takes_sink = True

    def __init__(
        self,
        spark: SparkSession,
        transport: Transport,
        record_id: str = "record_id",
        options: ExportOptions | None = None,
        parallel: int = 8,
        per_task: int = 4,
    ) -> None:
        self._spark, self._transport = spark, transport
        self.record_id, self._options = record_id, options or ExportOptions()
        self._parallel = parallel
        self.wave_chunks = parallel * per_task
        self._columns: list[str] = []

    def _header(self, params: dict[str, str]) -> list[str]:
        stream = self._transport(params)
        try:
            return read_header(stream)
        finally:
            stream.close()

    def _one(
        self, params: dict[str, str], columns: list[str], keep: tuple[str, ...] = ()
    ) -> DataFrame:
        fetched = run_requests(
            single_request(self._spark, params), self._transport, columns, 1, empty_is_error=False
        )
        return _raise_on_error(fetched, keep)

    def dictionary(self) -> DataFrame | None:
        return conform(self._one(DICTIONARY_REQUEST, DICTIONARY_COLUMNS))

    def _id_params(self) -> dict[str, str]:
        return {**self._options.record_params(scoped=False), "fields": self.record_id}

    def record_ids(self) -> DataFrame:
        """IDs as the service lists them: the column of their name, or else the only one."""
        answer = self._one(self._id_params(), [self.record_id], keep=(EXTRA,))
        only = F.get(F.map_values(EXTRA), F.lit(0))
        return answer.select(F.coalesce(F.col(self.record_id), only).alias(self.record_id))

    def counted_ids(self, done: DataFrame | None = None) -> DataFrame:
        """Each of these IDs once with its rows, the missing one too."""
        return counted_cells(single_request(self._spark, self._id_params()), self._transport, self.record_id)

    def audit_log(self, begin: date, end: date) -> DataFrame | None:
        """Entries of each day in the range; a failed day leaves a status row."""
        windows = day_windows_between(self._spark, begin, end)
        columns = ["timestamp", "username", "action", "details", "record", "project_id"]
        return run_requests(
            day_requests(windows, AUDIT_REQUEST),
            self._transport,
            columns,
            self._parallel,
            empty_is_error=False,
        )

    def fetch(
        self,
        chunks: DataFrame,
        everything: bool,
        done: DataFrame | None = None,
        unlanded: DataFrame | None = None,
        sink: Sink | None = None,
    ) -> DataFrame:
        """Rows and status rows of every chunk, or what a ``sink`` tells that takes them where they arrive.

        Columns come from the first answer's header; columns that other answers
        bring are kept in a map per row.
        """
        params = self._options.record_params()
        if not self._columns:
            first = chunks.agg(F.min(self.record_id)).first()[0]
            self._columns = self._header({**params, "records": str(first)})
        columns = self._columns or [self.record_id]
        return run_requests(
            chunk_requests(chunks, self.record_id, params),
            self._transport,
            columns,
            self._parallel,
            sink=sink,
        )

    def faults(self) -> DataFrame | None:
        return None


def _raise_on_error(fetched: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a single request; its failure fails the job that reads them."""
    failed = F.col(STATUS) == "ERROR"
    checked = fetched.filter(
        F.when(failed, F.raise_error(F.col(ERROR)).cast("boolean")).otherwise(
            F.col(STATUS).isNull()
        )
    )
    return checked.drop(*[c for c in CONTROL if c not in keep])



