"""Versions of a table: parts that never change, and a manifest that names the parts of a version.

A version is published by one rename of its manifest, so a load that dies before that leaves
the table as it was: readers never see parts that no manifest names. A DataFrame keeps to the
version it was made from. The parts of the last few versions stay; older ones, and what killed
loads have left, go after the next version is out. One load at a time may write a table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"
PART = "_part"
KEPT = 2  # versions, the latest among them


@dataclass(frozen=True)
class Part:
    """A folder of a version, with what its writer noted about it."""

    folder: str
    note: str


class VersionedTable:
    """A Parquet table under ``path``, in any file system that Spark can reach.

    Files written there without a manifest are version 0: they are read as long as there is
    no other, and the first version that appends takes their rows over.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")
        place = self._place("")
        self._store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _place(self, name: str):
        return self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)

    def _names(self, folder: str = "") -> list[str]:
        place = self._place(folder)
        if not self._store.exists(place):
            return []
        return sorted(status.getPath().getName() for status in self._store.listStatus(place))

    def _unversioned(self) -> list[str]:
        """Files and partition folders of version 0."""
        hidden = (".", f"{PART}=")
        return [n for n in self._names() if not n.startswith(hidden) and (not n.startswith("_") or "=" in n)]

    def numbers(self) -> list[int]:
        """The versions that can be read, in order."""
        return [int(name) for name in self._names(MANIFESTS) if name.isdigit()]

    def parts(self, number: int | None = None) -> list[Part]:
        """Parts of a version, by default the latest; none before the first."""
        number = number or max(self.numbers(), default=0)
        if not number:
            return []
        stream = self._store.open(self._place(f"{MANIFESTS}/{number:010d}"))
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        return [Part(*line.split("\t", 1)) for line in text.splitlines()]

    def read(self, number: int | None = None, parts: list[Part] | None = None) -> DataFrame:
        """Rows of a version, by default the latest, or of some of its parts."""
        parts = self.parts(number) if parts is None else parts
        reader = self._spark.read.option("mergeSchema", "true")
        names = [part.folder for part in parts] or self._unversioned() or [f"{MANIFESTS}/{0:010d}"]
        folders = [f"{self._path}/{name}" for name in names]
        if not parts:
            return reader.option("basePath", self._path).parquet(*folders)
        return reader.option("basePath", self._path).parquet(*folders).drop(PART)

    def publish(
        self, df: DataFrame, append: bool = False, partition_by: str | None = None, note: str = "", **options
    ) -> int:
        """Write rows as the next version, beside those of the latest one or instead of them."""
        latest = max(self.numbers(), default=0)
        kept = self.parts(latest) if append and latest else []
        if append and not latest and self._unversioned():
            df = self.read(parts=[]).unionByName(df, allowMissingColumns=True)
        part = Part(f"{PART}=p{uuid.uuid4().hex}", note)
        writer = df.write.mode("error").options(**options)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self._path}/{part.folder}")
        self._announce(latest + 1, [*kept, part])
        self.sweep()
        return latest + 1

    def _announce(self, number: int, parts: list[Part]) -> None:
        text = "".join(f"{part.folder}\t{part.note}\n" for part in parts)
        draft, final = self._place(f"{MANIFESTS}/.{uuid.uuid4().hex}"), self._place(f"{MANIFESTS}/{number:010d}")
        out = self._store.create(draft, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if self._store.exists(final) or not self._store.rename(draft, final):
            self._store.delete(draft, False)
            raise FileExistsError(f"version {number} of {self._path} was published by another load")

    def sweep(self, kept: int = KEPT) -> None:
        """Remove versions but the last ``kept``, and parts that none of these names."""
        numbers = self.numbers()
        named = {part.folder for number in numbers[-kept:] for part in self.parts(number)}
        for number in numbers[:-kept]:
            self._store.delete(self._place(f"{MANIFESTS}/{number:010d}"), False)
        for name in self._names():
            if name.startswith(f"{PART}=") and name not in named:
                self._store.delete(self._place(name), True)
