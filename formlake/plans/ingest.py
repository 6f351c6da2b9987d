"""Resumable, chunked, failure-isolating load of a project.

Rows land as text in a raw table, one partition per run, beside the status rows of
failed and finished chunks or files. Chunks land in waves, each a Spark job of its own:
a wave that dies takes none of the others with it. The IDs of what has landed are kept beside
the raw table, run by run, so the next run asks only for what is missing and rereads no rows.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.functions.text import elapsed_string, stamp_literal
from formlake.operators import chunks as C
from formlake.operators.audit import conform_audit, daily_counts, default_range
from formlake.operators.dictionary import with_config_row
from formlake.operators.ids import pending_ids
from formlake.operators.journal import (
    COMPLETED,
    STARTED,
    Journal,
    now,
    since_last_start,
    transfer_status,
)
from formlake.operators.lookup import attach
from formlake.operators.narrowing import (
    SPARK_TYPE,
    apply_types,
    class_counts,
    decide_types,
    merge_counts,
)
from formlake.plans.landed_index import index_run, indexed_ids, unindexed_runs, unlanded_ids
from formlake.project import RUN, Project
from formlake.session import materialise
from formlake.sources.requests import CONTROL, ERROR, EXTRA, KEY, ROWS, SECONDS, STATUS

_COUNTS = T.StructType(
    [
        T.StructField(RUN, T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("classes", T.IntegerType()),
        T.StructField("n_present", T.LongType()),
        T.StructField("n_blank", T.LongType()),
    ]
)


class TransferError(RuntimeError):
    """The source gave no record IDs, so nothing could be loaded."""


@dataclass
class TransferResult:
    """Outcome of a load; true when every chunk arrived."""

    success: bool
    n_chunks: int = 0
    failed_chunks: int = 0
    rows: int = 0
    time_s: int = 0
    status: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.success

    def error_chunks(self) -> DataFrame | None:
        """Numbers of the chunks that failed in this run."""
        if self.status is None:
            return None
        return self.status.filter(F.col("status") == C.ERROR).select("chunk").orderBy("chunk")


def landed(project: Project, runs: list[str] | None = None) -> DataFrame:
    """Landed rows as text: all rows but those of failed chunks."""
    raw = project.read(project.raw)
    if runs is not None:
        raw = raw.filter(F.col(RUN).isin(runs))
    rows = raw.filter(F.col(STATUS).isNull())
    failed = _failed_with_rows(project, raw)
    if not failed.isEmpty():
        rows = attach(rows, materialise(failed), [RUN, KEY], "left_anti")
    extra = _extra_columns(raw)
    keep = [c for c in raw.columns if c not in CONTROL and c != RUN]
    added = [n for n in extra if n not in keep]
    # Rows of one run need no sort by run where they are written as a partition.
    run = F.lit(runs[0]).alias(RUN) if runs is not None and len(runs) == 1 else F.col(RUN)
    return rows.select(
        *[
            F.coalesce(f"`{c}`", F.try_element_at(EXTRA, F.lit(c))).alias(c)
            if c in extra
            else F.col(f"`{c}`")
            for c in keep
        ],
        *[F.try_element_at(EXTRA, F.lit(n)).alias(n) for n in added],
        run,
    )


def _failed_with_rows(project: Project, raw: DataFrame) -> DataFrame:
    """Failed chunks and files that have rows in the raw table.

    Where chunks land whole these are only files that landed in slices, some of which failed.
    """
    told = raw.filter(F.col(STATUS).isNotNull()).groupBy(RUN, KEY)
    told = told.agg(F.max(F.col(STATUS) == C.ERROR).alias("failed"), F.max(F.col(STATUS) != C.ERROR).alias("landed"))
    return told.filter("failed AND landed" if project.lands_whole_chunks else "failed").select(RUN, KEY)


def _extra_columns(raw: DataFrame) -> list[str]:
    """Columns that only some answers brought; as many as the schema drifted by."""
    if EXTRA not in raw.columns:
        return []
    names = raw.filter(F.col(EXTRA).isNotNull()).select(F.explode(F.map_keys(EXTRA)).alias("n"))
    return sorted(r["n"] for r in names.distinct().collect())


def _load_dictionary(project: Project, source, journal: Journal, refresh: bool) -> None:
    if not refresh and project.is_filled(project.metadata):
        journal.add(C.INFO, "Dictionary: kept, stored by an earlier run")
        return
    journal.add(C.INFO, "Dictionary: asking the source")
    try:
        dictionary = source.dictionary()
        if dictionary is not None:
            dictionary = materialise(dictionary)  # one answer, read more than once
        if dictionary is None or dictionary.isEmpty():
            raise ValueError("the source gave none")
        project.write(with_config_row(dictionary, source.record_id), project.metadata, "overwrite")
        journal.add(C.INFO, "Dictionary: stored")
    except Exception as e:  # a load without a dictionary is still a load
        journal.add(C.WARNING, f"Dictionary: not available, {_brief(e)}")


def _load_audit(
    project: Project, source, journal: Journal, begin: date, end: date, refresh: bool
) -> None:
    """Store the entries of a range of days; other days stay as they are."""
    if project.audit_log is None:
        return
    if not refresh and project.is_filled(project.audit_log):
        journal.add(C.INFO, "Audit log: kept, stored by an earlier run")
        return
    journal.add(C.INFO, "Audit log: asking the source")
    try:
        entries = source.audit_log(begin, end)
        if entries is None:
            journal.add(C.INFO, "Audit log: the source keeps none")
            return
        problems = None
        if STATUS in entries.columns:
            entries = materialise(entries)
            problems = materialise(entries.filter(F.col(STATUS) == C.ERROR).select(KEY, ERROR))
            entries = attach(
                entries.filter(F.col(STATUS).isNull()), problems.select(KEY), [KEY], "left_anti"
            )
        dated = conform_audit(entries).withColumn("day", F.col("timestamp").cast("date"))
        dated = materialise(dated)
        project.replace_partitions(dated, project.audit_log, "day")
        stamp = stamp_literal(now()).alias("timestamp")
        journal.add_many(
            daily_counts(dated).select(
                stamp,
                F.lit(C.INFO).alias("type"),
                F.format_string("Audit log: %d entries of %s", "n", F.col("day").cast("string")).alias("message"),
            )
        )
        journal.add(C.INFO, f"Audit log: {dated.count()} entries from {begin} to {end} stored")
        if problems is not None:
            journal.add_many(
                problems.select(
                    stamp,
                    F.lit(C.WARNING).alias("type"),
                    F.concat(F.lit("Audit log: "), F.col(KEY), F.lit(" is missing, "), F.col(ERROR)).alias("message"),
                )
            )
    except Exception as e:
        journal.add(C.WARNING, f"Audit log: not available, {_brief(e)}")


def _brief(e: Exception) -> str:
    """The telling line of an error: for an error in a Python worker, the last one."""
    text, cause = str(e), getattr(e, "java_exception", None)
    while cause is not None:  # what began it says more than the job that ended with it
        text, cause = cause.getMessage() or text, cause.getCause()
    lines = [line.strip() for line in text.splitlines() if line.strip()]
    if not lines:
        return type(e).__name__
    line = lines[-1] if "Python worker" in lines[0] else lines[0]
    return re.sub(r"^\[USER_RAISED_EXCEPTION\] | SQLSTATE: \w+$", "", line)


def _index_landed(project: Project, record_id: str) -> None:
    """Index the IDs of runs that have landed: the last one's, and those whose load died."""
    for run in unindexed_runs(project):
        index_run(project, run, landed(project, [run]), record_id)


def unlanded(project: Project, ids: DataFrame, record_id: str) -> DataFrame:
    """Those of ``ids`` that have not landed, whichever way the project knows."""
    if not project.indexes_ids:
        return pending_ids(ids, landed(project), record_id)
    _index_landed(project, record_id)
    return unlanded_ids(project, ids, record_id)


def pending_record_ids(project: Project, source) -> DataFrame:
    """Record IDs of the source that a load would ask for now."""
    ids = materialise(source.counted_ids().select(source.record_id).filter(F.col(source.record_id).isNotNull()))
    return unlanded(project, ids, source.record_id) if project.exists(project.raw) else ids


def _chunk_status(project: Project, source, chunks: DataFrame, run: str) -> DataFrame:
    """Status of this run's chunks, from what the raw table holds."""
    arrived = project.exists(project.raw)
    if not source.reports_status:
        if arrived and project.indexes_ids:
            return C.counted_status(indexed_ids(project, source.record_id, run), chunks, source.record_id)
        rows = landed(project, [run]) if arrived else chunks.select(source.record_id).limit(0)
        return C.delivered_status(rows, chunks, source.record_id)
    sizes = chunks.groupBy("chunk").agg(F.count("*").alias("n_ids"))
    if not arrived:
        reported = project.spark.createDataFrame(
            [], "chunk int, n_rows bigint, status string, error string, seconds double"
        )
    else:
        raw = project.read(project.raw).filter(F.col(RUN) == run)
        reported = raw.filter(F.col(STATUS).isNotNull()).select(
            F.col(KEY).cast("int").alias("chunk"),
            F.col(ROWS).alias("n_rows"),
            F.col(STATUS).alias("status"),
            F.col(ERROR).alias("error"),
            F.col(SECONDS).alias("seconds"),
        )
    return (
        sizes.join(reported, "chunk", "left")
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
        .withColumn("error", F.when(F.col("status").isNull(), "its wave failed").otherwise(F.col("error")))
        .withColumn("status", F.coalesce("status", F.lit(C.ERROR)))
    )


def _file_notes(project: Project, source, run: str, status: str, begin: str) -> DataFrame | None:
    """What this run has to say about files of a status, once for each file and message."""
    if source.reports_status or not project.exists(project.raw):
        return None
    raw = project.read(project.raw)
    if ERROR not in raw.columns:
        return None
    told = raw.filter((F.col(RUN) == run) & (F.col(STATUS) == status) & F.col(ERROR).isNotNull())
    return told.select(F.concat(F.lit(begin), F.col(KEY), F.lit(": "), F.col(ERROR)).alias("message")).distinct()


def _file_faults(project: Project, source, run: str) -> DataFrame | None:
    """Messages about files of this run that could not be read; their rows count as not landed."""
    return _file_notes(project, source, run, C.ERROR, "Unable to read ")


def _runs(project: Project, table: str) -> set[str]:
    if not project.exists(table):
        return set()
    return {r[0] for r in project.read(table).select(RUN).distinct().collect()}


def publish_typed(project: Project, journal: Journal, **options) -> int:
    """Bring the typed table up to date with what has landed; returns its rows.

    Only runs not yet profiled are read again, unless they change a column's type.
    """
    profiled = _runs(project, project.type_counts)
    arrived = _runs(project, project.raw)
    new = sorted(arrived - profiled)
    if new:
        rows = landed(project, new).drop(RUN)
        counted = class_counts(rows)
        project.write(
            project.spark.createDataFrame(
                [(new[-1], i, *c) for i, c in enumerate(counted)]
                + [(r, -1, "", 0, 0, 0) for r in new[:-1]],
                _COUNTS,
            ).coalesce(1),
            project.type_counts,
        )
    counts = merge_counts(project.read(project.type_counts).filter("position >= 0"))
    profile = decide_types(counts, **options)
    journal.add(C.INFO, f"Types: {len(profile)} columns profiled")
    for p in profile:
        if p.final_type != "VARCHAR" or p.level == C.WARNING:
            journal.add(p.level, p.message)

    published = _runs(project, project.data)
    missing = sorted(arrived - published)
    decided = {p.column_name: SPARK_TYPE.get(p.final_type, "string") for p in profile}
    if published:
        known = {f.name: f.dataType.simpleString() for f in project.read(project.data).schema.fields}
        # New columns are null in the rows of earlier runs; only a new type rewrites those.
        if all(known.get(n, t) == t for n, t in decided.items()):
            if missing:
                project.write(apply_types(landed(project, missing), profile), project.data, "append", RUN)
            return project.read(project.data).count()
    project.write(apply_types(landed(project, sorted(arrived)), profile), project.data, "overwrite", RUN)
    return project.read(project.data).count()


def ingest(
    project: Project,
    source,
    chunk_size: int = C.DEFAULT_CHUNK_SIZE,
    audit_begin: date | None = None,
    audit_end: date | None = None,
    refresh: bool = False,
    scope: str = "all",
    **typing_options,
) -> TransferResult:
    """Load a project from its source, or go on with an unfinished load.

    ``refresh`` loads the dictionary and the audit log again and looks for new
    records even after a complete load. ``scope="last_run"`` judges completeness by
    the latest run's log entries instead of the whole log.
    """
    journal = Journal(project.spark, project.journal_sink())
    try:
        return _ingest(
            project, source, journal, chunk_size, audit_begin, audit_end, refresh, scope, typing_options
        )
    except TransferError:
        raise
    except Exception as e:
        journal.add(C.ERROR, f"Transfer broken off: {_brief(e)}")
        journal.flush()
        raise


def _ingest(
    project, source, journal, chunk_size, audit_begin, audit_end, refresh, scope, typing_options
) -> TransferResult:
    started = time.monotonic()

    def elapsed() -> float:
        return time.monotonic() - started

    has_raw = project.exists(project.raw)
    if project.exists(project.data) and project.transfer_log and project.exists(project.transfer_log):
        log = project.read(project.transfer_log)
        state = transfer_status(since_last_start(log) if scope == "last_run" else log).first()
        if state["status"] == "complete" and not refresh:
            return TransferResult(True)
        if state["status"] == "resume_with_errors":
            journal.add(C.WARNING, "Going on with a transfer that had errors")
        elif state["status"] == "complete":
            journal.add(C.INFO, "Looking for what is new since a complete transfer")
        else:
            journal.add(C.INFO, "Going on with an unfinished transfer")

    journal.add(C.INFO, STARTED)
    _load_dictionary(project, source, journal, refresh)
    first, last = default_range()
    _load_audit(project, source, journal, audit_begin or first, audit_end or last, refresh)
    journal.add(C.INFO, "Record IDs: asking the source")
    record_id = source.record_id
    done = _done_files(project) if has_raw and not source.reports_status else None
    try:
        counted = materialise(source.counted_ids(done))
        ids = counted.filter(F.col(record_id).isNotNull())
        if ids.isEmpty():
            raise TransferError("the source gave no records")
    except Exception as e:
        journal.add(C.ERROR, f"Record IDs: not available, {_brief(e)}")
        journal.flush()
        raise TransferError(f"unable to fetch record IDs: {_brief(e)}") from e
    nameless = counted.filter(F.col(record_id).isNull()).select("n_rows").first()
    if nameless:
        journal.add(C.WARNING, f"Record IDs: {nameless[0]} rows without one are left out")

    pending = new = ids.select(record_id)
    if has_raw:
        pending = new = materialise(unlanded(project, ids, record_id))
        if done is not None:  # a file that never landed may hold more rows of a landed record
            pending = materialise(pending.union(ids.filter("in_new_file").select(record_id)).distinct())
    chunked = C.assign_chunks(pending, record_id, chunk_size, already_distinct=True)
    figures = chunked.agg(F.count("*").alias("ids"), F.max("chunk").alias("chunks")).first()
    if figures["ids"] == 0:
        journal.add(C.INFO, "Record IDs: none to load")
        rows = publish_typed(project, journal, **typing_options)
        n_faults = _log_faults(journal, source.faults())
        _close(journal, n_faults == 0, 0, n_faults, elapsed_string(elapsed()))
        return TransferResult(n_faults == 0, rows=rows, time_s=round(elapsed()))

    known = f" of {ids.count()}" if has_raw else ""
    journal.add(C.INFO, f"Record IDs: {figures['ids']}{known} to load")
    journal.add(C.INFO, f"Chunks: {figures['chunks']} of at most {chunk_size} record IDs")
    journal.flush()

    run = now().strftime("%Y%m%dT%H%M%S%f")
    wave = source.wave_chunks or figures["chunks"]
    waves = C.laid_out_in_waves(chunked, wave) if wave < figures["chunks"] else None
    for low in range(1, figures["chunks"] + 1, wave):
        part = chunked if waves is None else waves.filter(F.col("wave") == low // wave).drop("wave")
        try:
            project.land_from(source, run, part, not has_raw, done, new)
        except Exception as e:  # the other waves still land
            upto = min(low + wave - 1, figures["chunks"])
            journal.add(C.ERROR, f"Chunks {low} to {upto}: lost with their job, {_brief(e)}")
            journal.flush()

    if project.indexes_ids and project.exists(project.raw):
        _index_landed(project, record_id)
    status = materialise(_chunk_status(project, source, chunked, run))
    project.write(status.withColumn(RUN, F.lit(run)), project.chunk_status, "append", RUN)
    journal.add_many(
        C.chunk_messages(status).withColumn("timestamp", stamp_literal(now()))
    )
    return _finish(project, source, journal, chunked, status, run, elapsed, typing_options)


def _done_files(project: Project) -> DataFrame | None:
    """Files that landed whole in some run; None where the raw table has no files."""
    raw = project.read(project.raw)
    if ERROR not in raw.columns:
        return None
    # A large file lands in slices: it is whole if none of a run's slices failed.
    told = raw.filter(F.col(STATUS).isNotNull()).groupBy(RUN, KEY).agg(F.max(F.col(STATUS) == C.ERROR).alias("failed"))
    return materialise(told.filter("NOT failed").select(KEY).distinct())


def _log_faults(journal: Journal, faults: DataFrame | None, kind: str = C.ERROR) -> int:
    if faults is None:
        return 0
    faults = materialise(faults)
    journal.add_many(
        faults.select(
            stamp_literal(now()).alias("timestamp"), F.lit(kind).alias("type"), "message"
        )
    )
    return faults.count()


def _close(journal: Journal, success: bool, failed: int, n_faults: int, detail: str) -> None:
    if success:
        journal.add(C.INFO, f"{COMPLETED} {detail}")
    else:
        journal.add(C.ERROR, f"Faults: {failed} chunks, {n_faults} source files")
        journal.add(C.WARNING, f"Transfer incomplete after {detail}")
    journal.flush()


def _finish(
    project, source, journal, chunked, status, run, elapsed, typing_options
) -> TransferResult:
    closing = C.outcome(C.tallies(status)).first()
    n_faults = _log_faults(journal, _file_faults(project, source, run))
    _log_faults(journal, _file_notes(project, source, run, C.SUCCESS, "Read with remarks: "), C.WARNING)
    failed = closing["failed_chunks"]
    if failed:
        lost = C.failed_ids(chunked, status, source.record_id).count()
        journal.add(C.INFO, f"Record IDs: {lost} in failed chunks")

    total = 0
    if failed < closing["n_chunks"] or project.exists(project.data):
        total = publish_typed(project, journal, **typing_options)
        journal.add(C.INFO, f"Records: {total} rows in the table")

    detail = (
        f"{elapsed_string(elapsed())} with {closing['successful_chunks']} of "
        f"{closing['n_chunks']} chunks successful, {failed} failed"
    )
    if source.reports_status:
        asked = status.agg(F.sum("seconds")).first()[0] or 0.0
        detail += f", {elapsed_string(asked)} of requests"
    success = closing["success"] and n_faults == 0
    _close(journal, success, failed, n_faults, detail)
    return TransferResult(
        success, closing["n_chunks"], failed, total, round(elapsed()), status
    )


def retry_failed(project: Project, source, **options) -> TransferResult:
    """Ask again for every record that has not landed, the failed chunks' among them."""
    return ingest(project, source, **{"refresh": False, **options})
