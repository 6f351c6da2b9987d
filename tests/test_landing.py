"""The landing sink: whole chunks or nothing, whatever dies."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from formlake import Project, ingest
from formlake.operators import chunks as C
from formlake.plans.ingest import landed
from formlake.sinks import landing
from formlake.sinks.landing import LandingWriter, land, land_where_made
from formlake.sources.projects import FolderSource, TableSource
from formlake.sources.requests import KEY, STATUS, TOLD

NAMES = ["v", KEY, STATUS]


def batch(*rows):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=NAMES)


def chunk(key, rows, status="SUCCESS"):
    return [(f"{key}-{i}", key, None) for i in range(rows)] + [(None, key, status)]


def rows_of(path):
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
    return sorted((r["v"] or "", r[KEY] or "", r[STATUS] or "") for f in files for r in pq.read_table(f, partitioning=None).to_pylist())


@pytest.mark.parametrize("held", [1, 1 << 20])
@pytest.mark.parametrize("size", [1, 2, 100])
def test_failed_chunks_leave_their_status_only(tmp_path, monkeypatch, held, size):
    monkeypatch.setattr(landing, "HELD_BYTES", held)
    rows = chunk("a", 3) + chunk("b", 2, "ERROR") + chunk("c", 0, "ERROR") + chunk("d", 1) + [("free", None, None)]
    writer = LandingWriter({"path": str(tmp_path / "raw"), "into": "_run=1"})
    done = writer.write(iter([batch(*rows[i : i + size]) for i in range(0, len(rows), size)]))
    assert rows_of(tmp_path / "raw" / "_run=1") == [] and len(done.files) == (1 if held > 1 else 3)
    writer.commit([done, None])
    wanted = [r for r in rows if r[1] != "b" or r[2]]
    assert rows_of(tmp_path / "raw" / "_run=1") == sorted(tuple(x or "" for x in r) for r in wanted)
    assert not any(os.scandir(tmp_path / "raw" / "_staging"))


def test_what_did_not_count_goes(tmp_path):
    writer = LandingWriter({"path": str(tmp_path), "into": "_run=1"})
    counted, repeated = (writer.write(iter([batch(*chunk("a", 2))])) for _ in range(2))
    assert counted.files != repeated.files
    writer.commit([counted])
    assert len(rows_of(tmp_path / "_run=1")) == 3 and rows_of(tmp_path / "_staging") == []
    writer = LandingWriter({"path": str(tmp_path), "into": "_run=2"})
    writer.write(iter([batch(*chunk("b", 2))]))
    writer.abort([None])
    assert len(rows_of(tmp_path)) == 3
    with pytest.raises(RuntimeError):  # a chunk must end
        writer.write(iter([batch(("x", "k", None))]))


def test_a_job_that_dies_leaves_nothing(spark, tmp_path):
    good = spark.createDataFrame([(f"{i}", None, None) for i in range(50)], "v string, _key string, _status string")
    land(good.repartition(5), str(tmp_path), "_run=1")
    bad = good.withColumn("v", F.when(F.col("v") == "37", F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        land(bad.repartition(5), str(tmp_path), "_run=2")
    assert not os.path.exists(tmp_path / "_run=2") and rows_of(tmp_path / "_staging") == []
    assert spark.read.parquet(str(tmp_path)).count() == 50


def test_reading_needs_no_join(spark, tmp_path, folder):
    records = tmp_path / "records"
    records.mkdir()
    (tmp_path / "metadata.csv").write_bytes(b"field_name,form_name\nid,main\n")
    (records / "good.csv").write_bytes(b"id,v\n1,a\n2,b\n")
    (records / "bad.csv").write_bytes(b"id,v\n3,a\n4,b,c,d\n")
    project = Project(spark, root=f"{folder}/p", record_id="id", audit_log=None)
    assert not ingest(project, FolderSource(spark, str(tmp_path), "id"))
    raw = project.read(project.raw)
    assert raw.filter(F.col(STATUS).isNull()).count() == 2 and raw.filter(F.col(STATUS) == "ERROR").count() == 1
    plan = landed(project)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and landed(project).count() == 2


def test_maps_land_as_they_are(spark, tmp_path):
    rows = [("a", {"x": "1", "y": None}), ("b", None), ("c", {"x": "3"}), ("d", None)]
    typed = [(v, "k", None, m) for v, m in rows] + [(None, "k", "SUCCESS", None)]
    schema = "v string, _key string, _status string, _extra map<string,string>"
    land(spark.createDataFrame(typed, schema).coalesce(1), str(tmp_path), "_run=1")
    found = spark.read.parquet(str(tmp_path))
    assert found.schema["_extra"].dataType.simpleString() == "map<string,string>"
    assert sorted((r["v"], r["_extra"]) for r in found.filter("v IS NOT NULL").collect()) == rows
    assert found.filter("_extra IS NULL").count() == 3


def test_missing_maps_cost_no_walk_over_the_batch(spark, tmp_path):
    """The time of a batch of missing maps once grew with the square of its rows."""
    plain = spark.range(0, 150_000, 1, 1).selectExpr("'v' AS v", "cast(null AS string) AS _key", "cast(null AS string) AS _status")
    with_maps = plain.withColumn("_extra", F.lit(None).cast("map<string,string>"))
    took = {}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "150000")
    try:
        for name, rows in (("warm", with_maps.limit(10)), ("plain", plain), ("maps", with_maps)):
            began = time.monotonic()
            land(rows, f"{tmp_path}/{name}", "_run=1")
            took[name] = time.monotonic() - began
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert spark.read.parquet(f"{tmp_path}/maps").count() == 150_000
    assert took["maps"] < 4 * took["plain"] + 4


def test_rows_land_where_they_are_made(spark, tmp_path):
    def make(deadly):
        def tasks(sink):
            def write(batches):
                def rows():
                    for given in batches:
                        for i in given.column(0).to_pylist():
                            if i == deadly:
                                raise ValueError("broken")
                            made = [(f"{i}-{n}", f"{i}", None) for n in range(3)]
                            made.append((None, f"{i}", "ERROR" if i == 2 else "SUCCESS"))
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*made)], names=["v", KEY, STATUS])

                yield from sink(rows())

            return spark.range(0, 6, 1, 3).mapInArrow(write, f"{TOLD} string")

        return tasks

    land_where_made(make(None), str(tmp_path), "_run=1")
    found = rows_of(tmp_path / "_run=1")
    assert [r[0] for r in found if r[0]] == [f"{i}-{n}" for i in (0, 1, 3, 4, 5) for n in range(3)]
    assert [r[1:] for r in found if r[2]] == [(f"{i}", "ERROR" if i == 2 else "SUCCESS") for i in range(6)]
    with pytest.raises(Exception, match="broken"):
        land_where_made(make(5), str(tmp_path), "_run=2")
    assert not os.path.exists(tmp_path / "_run=2") and rows_of(tmp_path / "_staging") == []


def test_one_run_is_written_without_a_sort(spark, folder):
    rows = spark.range(20).selectExpr("id", "cast(id AS string) AS v")
    project = Project(spark, root=f"{folder}/p", record_id="id", audit_log=None)
    ingest(project, TableSource(rows.filter("id < 5"), None, "id"))
    ingest(project, TableSource(rows, None, "id"), refresh=True)
    first, second = sorted(project.landed_runs())
    one, both = landed(project, [second]), landed(project, [first, second])
    assert f"{second} AS _run" in one._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["id"], r["_run"]) for r in one.collect()} == {(str(i), second) for i in range(5, 20)}
    assert {(r["id"], r["_run"]) for r in both.collect()} == {(str(i), first if i < 5 else second) for i in range(20)}


def test_held_batches_share_a_row_group(tmp_path):
    rows = chunk("a", 6)
    writer = LandingWriter({"path": str(tmp_path), "into": "_run=1"})
    writer.commit([writer.write(iter([batch(*rows[i : i + 2]) for i in range(0, len(rows), 2)]))])
    (file,) = (tmp_path / "_run=1").iterdir()
    assert pq.ParquetFile(file).metadata.num_row_groups == 1


def test_a_wave_reads_its_own_rows(spark):
    ids = spark.createDataFrame([(f"{i:04d}",) for i in range(1000)], "`record id` string")
    chunks = C.assign_chunks(ids, "record id", 7)
    waves = C.laid_out_in_waves(chunks, 20)
    assert waves.columns == ["record id", "chunk", "wave"] and waves.count() == 1000
    every = set(waves.inputFiles())
    for wave in range(8):
        part = waves.filter(F.col("wave") == wave)
        read = set(spark.read.parquet(*part.inputFiles()).inputFiles())
        assert {f.split("wave=")[1].split("/")[0] for f in read} == {str(wave)} or read == every
        assert "PartitionFilters: [isnotnull(wave" in part._jdf.queryExecution().executedPlan().toString()
        assert {r["chunk"] for r in part.collect()} == set(range(20 * wave + 1, min(143, 20 * wave + 20) + 1))
