"""Record IDs of what has landed, one sorted part for each run: a resume asks these, not the raw table.

A part holds each ID of a run's landed rows once, with its rows, in files of ascending ranges.
Their minima, maxima and Bloom filters let a reader that looks for some IDs pass over the rest.
A run whose part is missing, because its load died, is indexed by the next load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.operators.ids import pending_ids
from formlake.project import Project
from formlake.sinks.versions import VersionedTable

N_ROWS = "n_rows"


def _index(project: Project) -> VersionedTable:
    return project.versions(project.landed_ids)


def unindexed_runs(project: Project) -> list[str]:
    """Runs with a folder in the raw table whose IDs are not indexed; only folders are listed."""
    return sorted(set(project.landed_runs()) - {part.note for part in _index(project).parts()})


def index_run(project: Project, run: str, rows: DataFrame, record_id: str) -> None:
    """Add the IDs of a run's landed rows; a run without any gets an empty part."""
    ids = rows.filter(F.col(record_id).isNotNull()).groupBy(record_id).agg(F.count("*").alias(N_ROWS))
    ordered = ids.repartitionByRange(record_id).sortWithinPartitions(record_id)
    bloom = {f"parquet.bloom.filter.enabled#{record_id}": "true"}
    _index(project).publish(ordered, append=True, note=run, **bloom)


def indexed_ids(project: Project, record_id: str, run: str | None = None) -> DataFrame:
    """IDs of all indexed runs, or of one, with their rows; an ID may be in several runs."""
    index = _index(project)
    parts = [part for part in index.parts() if run is None or part.note == run]
    if not parts:
        return project.spark.createDataFrame([], f"`{record_id}` string, {N_ROWS} bigint")
    return index.read(parts=parts)


def unlanded_ids(project: Project, ids: DataFrame, record_id: str) -> DataFrame:
    """Those of ``ids`` (read twice) that no run has landed.

    The index is read between their least and greatest only.
    """
    known = indexed_ids(project, record_id)
    ends = ids.agg(F.min(record_id).alias("low"), F.max(record_id).alias("high")).first()
    if ends["low"] is not None:
        known = known.filter(F.col(record_id).between(ends["low"], ends["high"]))
    return pending_ids(ids, known, record_id)
