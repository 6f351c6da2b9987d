"""Versions of tables and the index of landed IDs: what a load that dies leaves readable, and what a resume reads."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from formlake import Project, TableSource, ingest
from formlake.plans import ingest as plan
from formlake.plans.ingest import pending_record_ids
from formlake.plans.landed_index import indexed_ids, unindexed_runs
from formlake.sinks.versions import VersionedTable


def values(df):
    return sorted(r["id"] for r in df.collect())


def source(spark, n, shift=0):
    rows = spark.range(1, n + 1).select(F.col("id").alias("record_id"), (F.col("id") + shift).alias("v"))
    return TableSource(rows, None, "record_id")


def project_at(spark, folder):
    return Project(spark, root=folder + "/p", audit_log=None)


def test_versions_are_read_apart(spark, folder):
    table = VersionedTable(spark, folder + "/t")
    with pytest.raises(AnalysisException):
        table.read()
    assert table.publish(spark.range(2), note="a") == 1
    held = table.read()
    assert table.publish(spark.range(2, 5), append=True, note="b") == 2
    assert [p.note for p in table.parts()] == ["a", "b"]
    assert values(held) == [0, 1] and values(table.read()) == [0, 1, 2, 3, 4] and values(table.read(1)) == [0, 1]
    table.publish(spark.range(9, 10))
    assert values(table.read()) == [9] and values(table.read(2)) == [0, 1, 2, 3, 4]
    assert table.numbers() == [2, 3]
    table.publish(spark.range(1))
    assert len([n for n in os.listdir(folder + "/t") if n.startswith("_part=")]) == 2


def test_partitions_new_columns_and_empty_rows(spark, folder):
    table = VersionedTable(spark, folder + "/t")
    first = spark.createDataFrame([(1, "x"), (2, "y")], "id int, _run string")
    table.publish(first, partition_by="_run")
    table.publish(first.limit(0), append=True, partition_by="_run")
    table.publish(first.selectExpr("id + 2 AS id", "'new' AS more", "'z' AS _run"), append=True, partition_by="_run")
    rows = sorted((r["id"], r["more"], r["_run"]) for r in table.read().collect())
    assert rows == [(1, None, "x"), (2, None, "y"), (3, "new", "z"), (4, "new", "z")]
    assert table.read().columns == ["id", "more", "_run"]


@pytest.mark.parametrize("partitioned", [False, True])
def test_files_without_a_manifest_are_taken_over(spark, folder, partitioned):
    rows = spark.range(3).withColumn("_run", F.lit("a"))
    writer = rows.write.partitionBy("_run") if partitioned else rows.write
    writer.parquet(folder + "/t")
    table = VersionedTable(spark, folder + "/t")
    assert values(table.read()) == [0, 1, 2] and table.numbers() == []
    table.publish(spark.range(7, 8).withColumn("_run", F.lit("b")), append=True, partition_by="_run")
    assert values(table.read()) == [0, 1, 2, 7]


@pytest.mark.parametrize("published", [0, 1])
def test_a_part_without_a_manifest_is_never_read(spark, folder, monkeypatch, published):
    table = VersionedTable(spark, folder + "/t")
    if published:
        table.publish(spark.range(2))

    def dies(self, number, parts):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(VersionedTable, "_announce", dies)
        table.publish(spark.range(5))
    if published:
        assert values(table.read()) == [0, 1]
    else:
        with pytest.raises(AnalysisException):
            table.read()
    table.publish(spark.range(3), append=True)
    assert values(table.read()) == ([0, 0, 1, 1, 2] if published else [0, 1, 2])
    assert len([n for n in os.listdir(folder + "/t") if n.startswith("_part=")]) == 1 + published


def test_two_loads_can_not_publish_one_version(spark, folder):
    table = VersionedTable(spark, folder + "/t")
    table.publish(spark.range(2))
    with pytest.raises(FileExistsError):
        table._announce(1, [])
    assert values(table.read()) == [0, 1] and table.numbers() == [1]


@pytest.mark.parametrize("change", [0, 3_000_000_000])  # the second load appends, or rewrites the table
def test_a_load_killed_while_it_publishes_leaves_the_old_table(spark, folder, monkeypatch, change):
    project = project_at(spark, folder)
    ingest(project, source(spark, 4, change))
    held = project.records()

    def dies(self, number, parts):
        if self._path.endswith("/data"):
            raise RuntimeError("killed")
        return announce(self, number, parts)

    announce = VersionedTable._announce
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(VersionedTable, "_announce", dies)
        ingest(project, source(spark, 9, change), refresh=True, overflow="bigint")
    assert project.records().count() == 4 and dict(project.records().dtypes)["v"] == ("string" if change else "int")
    assert ingest(project, source(spark, 9, change), refresh=True, overflow="bigint").rows == 9
    assert project.records().select("record_id").distinct().count() == 9 and held.count() == 4


def test_a_resume_reads_no_raw_file(spark, folder):
    project = project_at(spark, folder)
    ingest(project, source(spark, 40))
    pending = pending_record_ids(project, source(spark, 43))
    assert sorted(r["record_id"] for r in pending.collect()) == ["41", "42", "43"]
    assert pending.inputFiles() and all("/landed_ids/" in f for f in pending.inputFiles())
    plan_text = pending._jdf.queryExecution().executedPlan().toString()
    pushed = plan_text.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(record_id,1)" in pushed and "LessThanOrEqual(record_id,9)" in pushed
    assert pending_record_ids(project_at(spark, folder + "/none"), source(spark, 3)).count() == 3


def test_runs_of_dead_loads_are_indexed_by_the_next(spark, folder, monkeypatch):
    project = project_at(spark, folder)
    ingest(project, source(spark, 4))

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(plan, "index_run", dies)
        ingest(project, source(spark, 9), refresh=True)
    assert len(unindexed_runs(project)) == 1
    assert ingest(project, source(spark, 12), refresh=True).rows == 12
    assert unindexed_runs(project) == []
    counted = indexed_ids(project, "record_id").groupBy("record_id").agg(F.sum("n_rows").alias("n")).collect()
    assert len(counted) == 12 and all(r["n"] == 1 for r in counted)
