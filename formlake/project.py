"""A project: up to four public tables, and the landing tables behind them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.operators.audit import AUDIT_COLUMNS
from formlake.operators.dictionary import DICTIONARY_COLUMNS
from formlake.operators.journal import JOURNAL_SCHEMA, in_time_order
from formlake.sinks.inspect import inspect
from formlake.sinks.landing import land, land_where_made
from formlake.sinks.versions import VersionedTable

RUN = "_run"


@dataclass
class Project:
    """Tables of one project, as Parquet folders under ``root`` or in a catalog ``database``.

    ``transfer_log=None`` turns logging off; ``audit_log=None`` skips the audit log. Under
    ``root`` the typed records and the dictionary have versions; a catalog's are overwritten.
    """

    spark: SparkSession
    root: str | None = None
    database: str | None = None
    record_id: str = "record_id"
    data: str = "data"
    metadata: str = "metadata"
    transfer_log: str | None = "transfer_log"
    audit_log: str | None = "audit_log"
    raw: str = field(default="raw", kw_only=True)
    chunk_status: str = field(default="chunk_status", kw_only=True)
    type_counts: str = field(default="type_counts", kw_only=True)
    landed_ids: str = field(default="landed_ids", kw_only=True)

    def __post_init__(self) -> None:
        if (self.root is None) == (self.database is None):
            raise ValueError("give either a root folder or a catalog database")

    def _place(self, table: str) -> str:
        if self.database is not None:
            return table if "." in table else f"{self.database}.{table}"
        return f"{self.root.rstrip('/')}/{table}"

    def exists(self, table: str) -> bool:
        if self.database is not None:
            return self.spark.catalog.tableExists(self._place(table))
        try:
            self.read(table) if self._is_versioned(table) else self.spark.read.parquet(self._place(table))
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def _is_versioned(self, table: str) -> bool:
        return self.database is None and table in (self.data, self.metadata, self.landed_ids)

    def versions(self, table: str) -> VersionedTable:
        """The versions of the typed records, the dictionary or the landed IDs."""
        if not self._is_versioned(table):
            raise ValueError(f"{table} has no versions")
        return VersionedTable(self.spark, self._place(table))

    def read(self, table: str) -> DataFrame:
        if self.database is not None:
            return self.spark.table(self._place(table))
        if self._is_versioned(table):
            return self.versions(table).read()
        return self.spark.read.option("mergeSchema", "true").parquet(self._place(table))

    def write(
        self, df: DataFrame, table: str, mode: str = "append", partition_by: str | None = None
    ) -> None:
        if self._is_versioned(table):
            self.versions(table).publish(df, mode == "append", partition_by)
            return
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if self.database is None:
            writer.parquet(self._place(table))
        else:
            if mode == "append" and self.exists(table):
                self._align_catalog(df, table)
                known = self.read(table)
                aligned = known.limit(0).unionByName(df, allowMissingColumns=True)
                aligned.write.mode("append").insertInto(self._place(table))
                return
            writer.format("parquet").saveAsTable(self._place(table))

    @property
    def lands_whole_chunks(self) -> bool:
        """Whether rows of a failed chunk stay out of the raw table; a catalog table is written by Spark alone."""
        return self.database is None

    @property
    def indexes_ids(self) -> bool:
        """Whether the IDs of landed rows are kept apart from the raw table."""
        return self.database is None

    def landed_runs(self) -> list[str]:
        """Runs that have a folder in the raw table; no file is opened."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._place(self.raw))
        store = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []
        return [name.removeprefix(f"{RUN}=") for name in names if name.startswith(f"{RUN}=")]

    def land(self, rows: DataFrame, run: str) -> None:
        """Append what a source has brought to the raw table, as the partition of a run."""
        if self.lands_whole_chunks:
            land(rows, self._place(self.raw), f"{RUN}={run}")
        else:
            self.write(rows.withColumn(RUN, F.lit(run)), self.raw, "append", RUN)

    def land_from(self, source, run: str, *wanted) -> None:
        """Append what a source brings for the ``wanted`` chunks; tasks that receive it write it where they can."""
        if self.lands_whole_chunks and getattr(source, "takes_sink", False):
            place = self._place(self.raw)
            land_where_made(lambda sink: source.fetch(*wanted, sink=sink), place, f"{RUN}={run}")
        else:
            self.land(source.fetch(*wanted), run)

    def replace_partitions(self, df: DataFrame, table: str, partition_by: str) -> None:
        """Write ``df`` over the partitions it has rows for; all others stay."""
        if not self.exists(table):
            self.write(df, table, "append", partition_by)
        elif self.database is None:
            writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(partition_by).parquet(self._place(table))
        else:
            # A catalog table takes the mode from the session alone.
            mode = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(mode)
            self.spark.conf.set(mode, "dynamic")
            try:
                known = self.read(table).columns
                df.select(*known).write.mode("overwrite").insertInto(self._place(table), overwrite=True)
            finally:
                self.spark.conf.set(mode, before)

    def _align_catalog(self, df: DataFrame, table: str) -> None:
        """Add columns that a later load brings to a catalog table."""
        known = set(self.read(table).columns)
        new = [f for f in df.schema.fields if f.name not in known]
        if new:
            spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self._place(table)} ADD COLUMNS ({spec})")

    def is_filled(self, table: str) -> bool:
        return self.exists(table) and not self.read(table).isEmpty()

    def records(self, table: str | None = None, version: int | None = None) -> DataFrame:
        """The typed record table, lazily; ``version`` is one that ``versions`` lists."""
        if version is not None:
            return self.versions(table or self.data).read(version).drop(RUN)
        return self.read(table or self.data).drop(RUN)

    def dictionary(self) -> DataFrame | None:
        """The dictionary with its row positions, or None before it was loaded."""
        return self.read(self.metadata) if self.exists(self.metadata) else None

    def metadata_table(self) -> DataFrame:
        """The dictionary's fixed columns in export order."""
        return self.read(self.metadata).orderBy("position").select(*DICTIONARY_COLUMNS)

    def log(self) -> DataFrame:
        """The transfer log in time order."""
        if self.transfer_log is None:
            raise ValueError("this project keeps no transfer log")
        return in_time_order(self.read(self.transfer_log))

    def journal_sink(self):
        """Function that appends log entries, or None when logging is off."""
        if self.transfer_log is None:
            return None
        return lambda df: self.write(df.select(*JOURNAL_SCHEMA.names), self.transfer_log)

    def audit(self) -> DataFrame:
        if self.audit_log is None:
            raise ValueError("this project keeps no audit log")
        return self.read(self.audit_log).select(*AUDIT_COLUMNS)

    def inspect(self, table: str | None = None) -> DataFrame:
        """Columns of a table with their types."""
        return inspect(self.records(table))
