"""Session helpers: the shared folder and lineage cuts that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SPREAD_BYTES = 16 << 20  # of packed files, some five times that as text
_SETTING = "spark.checkpoint.dir"
_own_folder: dict[str, str] = {}  # by application, for local sessions without the setting
_cleared: set[str] = set()  # folders that go when the driver's JVM ends


def _is_local(spark: SparkSession) -> bool:
    """One process; ``local-cluster`` is not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(_SETTING, None) or _own_folder.get(spark.sparkContext.applicationId)


def _clear_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the folder made, and removed with all it holds when the driver's JVM ends."""
    if folder in _cleared:
        return
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(sc._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    _cleared.add(folder)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A checkpoint folder set in another way is used too. Only a local-mode session without
    either gets a folder of its own; on a cluster a machine-local folder would be lost with
    its machine. Spark's checkpoints are removed when the session's JVM ends.
    """
    named = _named_folder(spark)
    if not named:
        if not _is_local(spark):
            already = getattr(spark.sparkContext, "getCheckpointDir", lambda: None)()
            if already:
                return already
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="formlake-")
        _own_folder[spark.sparkContext.applicationId] = named
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
        _clear_at_exit(spark, spark.sparkContext.getCheckpointDir())
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, removed when the session's JVM ends.

    Lazy results may read it until then.
    """
    mine = f"{shared_dir(spark).rstrip('/')}/formlake/{spark.sparkContext.applicationId}"
    _clear_at_exit(spark, mine)
    return f"{mine}/{name}-{uuid.uuid4().hex}"


def _file_bytes(spark: SparkSession, files: list[str]) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    places = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in files]
    return sum(place.getFileSystem(conf).getFileStatus(place).getLen() for place in places)


def spread_if_few(df: DataFrame) -> DataFrame:
    """Use every core on input that arrives in few files, with no more than ``SPREAD_BYTES`` of them in a task.

    Only the file list is looked at, so no part of the plan runs for it.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not 0 < len(files) < cores:
        return df
    return df.repartition(max(cores, -(-_file_bytes(spark, files) // SPREAD_BYTES)))


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so later jobs reread instead of recompute."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
