"""The resumable load: tables, requests, folders, faults, drift and status."""

import csv
import io
import json
import pickle
import sys
import urllib.error
from datetime import date, datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from formlake import Project, ingest, retry_failed, session
from formlake.operators import chunks as C
from formlake.operators import journal as J
from formlake.operators.audit import audit_range, day_windows_between
from formlake.operators.lookup import attach, fits_broadcast, hot_keys, row_spread, sort_spread
from formlake.plans.ingest import TransferError, landed
from formlake.sources import transport as TR
from formlake.sources.csv_stream import csv_batches, read_header
from formlake.sources.export_folder import read_folder
from formlake.sources.projects import FolderSource, RequestSource, TableSource
from formlake.streaming.folder import land_available, stream_exports


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def to_csv(rows, columns):
    out = io.StringIO()
    writer = csv.DictWriter(out, columns, extrasaction="ignore")
    writer.writeheader()
    writer.writerows(rows)
    return io.BytesIO(out.getvalue().encode())


class Scripted:
    """Answers requests from rows in memory; failures are read from a file on each call."""

    def __init__(self, rows, dictionary, faults_path):
        self.rows, self.dictionary, self.faults_path = rows, dictionary, faults_path

    def __call__(self, params):
        with open(self.faults_path) as f:
            faults = json.load(f)
        if params["content"] == "metadata":
            if "metadata" in faults:
                raise OSError("no dictionary today")
            return to_csv(self.dictionary, ["field_name", "form_name", "field_type", "field_label",
                                            "select_choices_or_calculations"])
        if params["content"] == "log":
            day = params["beginTime"][:10]
            if day in faults:
                raise OSError("log offline")
            assert params["endTime"] == day + " 23:59:59"
            rows = [{"timestamp": day + " 12:00", "username": "u", "action": "edit"}]
            return to_csv(rows, ["timestamp", "username", "action"])
        if "records" not in params:
            if "ids" in faults:
                raise OSError("no identifiers")
            return to_csv([] if "no_ids" in faults else self.rows, ["record_id"])
        wanted = set(params["records"].split(","))
        found = [r for r in self.rows if r["record_id"] in wanted]
        if wanted & set(faults.get("records", [])) and len(wanted) > 1:
            raise OSError("gateway gave up, token not shown")
        if wanted & set(faults.get("empty", [])):
            found = []
        columns = list(dict.fromkeys(k for r in found for k in r)) or ["record_id"]
        return to_csv(found, columns)


def visits(n=50):
    rows = []
    for i in range(1, n + 1):
        for visit in (1, 2):
            row = {"record_id": str(i), "visit": str(visit), "sex": str(i % 2), "note": f'a "q", {i}\nx'}
            if i > 40:
                row["late_column"] = "z" * visit
            rows.append(row)
    return rows


DICTIONARY = [
    {"field_name": "record_id", "form_name": "main", "field_type": "text", "field_label": "ID"},
    {"field_name": "sex", "form_name": "main", "field_type": "radio", "field_label": "Gender",
     "select_choices_or_calculations": "0, Female | 1, Male"},
]


@pytest.fixture()
def service(spark, tmp_path):
    path = tmp_path / "faults.json"

    def set_faults(**faults):
        path.write_text(json.dumps(faults))

    set_faults()
    return RequestSource(spark, Scripted(visits(), DICTIONARY, str(path)), parallel=4), set_faults


def by_record(df):
    return {(r["record_id"], r["visit"]): r["late_column"] for r in df.collect()}


def test_requests_load_resume_and_drift(spark, service, folder):
    source, set_faults = service
    project = Project(spark, root=folder + "/p")
    set_faults(records=["13"], **{"2024-01-02": 1})
    first = ingest(project, source, chunk_size=10, audit_begin=date(2024, 1, 1),
                   audit_end=date(2024, 1, 4))
    assert not first and first.n_chunks == 5 and first.failed_chunks == 1 and first.rows == 80
    assert len(first.error_chunks().collect()) == 1
    assert project.audit().count() == 3
    log = {(r["type"], r["message"]) for r in project.log().collect()}
    assert any(t == "ERROR" and "gateway gave up" in m for t, m in log)
    assert any(t == "WARNING" and "2024-01-02" in m for t, m in log)
    assert any(t == "WARNING" and m.startswith("Transfer incomplete") for t, m in log)

    set_faults()
    second = retry_failed(project, source, chunk_size=10)
    assert second and second.n_chunks == 1 and second.rows == 100
    records = project.records()
    assert records.count() == 100
    got = by_record(records)
    assert got[(45, 2)] == "zz" and got[(3, 1)] is None and len(got) == 100
    assert {f.name: f.dataType.simpleString() for f in records.schema.fields}["record_id"] == "int"
    assert records.filter("record_id = 7 AND visit = 1").first()["note"] == 'a "q", 7\nx'

    third = ingest(project, source, chunk_size=10)
    assert third and third.n_chunks == 0 and third.rows == 100
    forms = project.metadata_table()
    assert forms.count() == 3 and len(forms.columns) == 19


def test_failed_chunk_leaves_no_rows(spark, service, folder):
    source, set_faults = service
    set_faults(empty=["20"])
    project = Project(spark, root=folder + "/p", audit_log=None)
    result = ingest(project, source, chunk_size=10)
    assert result.failed_chunks == 1 and result.rows == 80
    assert "returned no data" in {r["error"] for r in result.status.collect()}
    assert landed(project).select("record_id").distinct().count() == 40


def test_all_chunks_fail(spark, service, folder):
    source, set_faults = service
    set_faults(records=[str(i) for i in range(1, 51)])
    project = Project(spark, root=folder + "/p", audit_log=None)
    result = ingest(project, source, chunk_size=25)
    assert not result and result.failed_chunks == 2 and result.rows == 0
    set_faults()
    assert ingest(project, source, chunk_size=25).rows == 100


def test_no_ids_and_no_dictionary(spark, service, folder):
    source, set_faults = service
    set_faults(no_ids=1)
    project = Project(spark, root=folder + "/p", audit_log=None)
    with pytest.raises(TransferError):
        ingest(project, source)
    set_faults(ids=1)
    with pytest.raises(TransferError):
        ingest(project, source)
    assert project.log().filter("type = 'ERROR'").count() == 2
    assert not project.exists(project.data)


def test_load_without_a_dictionary(spark, service, folder):
    source, set_faults = service
    set_faults(metadata=1)
    project = Project(spark, root=folder + "/p", audit_log=None)
    assert ingest(project, source, chunk_size=25)
    assert project.dictionary() is None
    assert project.log().filter("message LIKE 'Dictionary: not available%today'").count() == 1


def test_complete_load_returns_at_once(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "record_id int, v string")
    project = Project(spark, root=folder + "/p", audit_log=None)
    assert ingest(project, TableSource(df, None, "record_id")).rows == 2
    entries = project.log().count()
    assert ingest(project, TableSource(df, None, "record_id"))
    assert project.log().count() == entries
    more = df.union(spark.createDataFrame([(3, "7")], df.schema))
    assert ingest(project, TableSource(more, None, "record_id"), refresh=True).rows == 3


def test_later_rows_may_change_a_type(spark, folder):
    schema = "record_id int, v string"
    first = spark.createDataFrame([(1, "10"), (2, "20")], schema)
    project = Project(spark, root=folder + "/p", audit_log=None, transfer_log=None)
    ingest(project, TableSource(first, None, "record_id"))
    assert project.records().schema["v"].dataType.simpleString() == "int"
    more = first.union(spark.createDataFrame([(3, "thirty")], schema))
    assert ingest(project, TableSource(more, None, "record_id")).rows == 3
    assert sorted(r["v"] for r in project.records().collect()) == ["10", "20", "thirty"]


def test_catalog_database(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS study_db")
    project = Project(spark, database="study_db", record_id="id", audit_log=None)
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert ingest(project, TableSource(df, None, "id")).rows == 2
    wider = spark.createDataFrame([(1, "x", 5), (2, "y", 6), (3, "z", 7)], "id int, v string, w int")
    assert ingest(project, TableSource(wider, None, "id"), refresh=True).rows == 3
    got = {r["id"]: r["w"] for r in project.records().collect()}
    assert got == {1: None, 2: None, 3: 7}
    assert [r["type"] for r in project.inspect().collect()] == ["INTEGER", "VARCHAR", "INTEGER"]
    for name in ("data", "raw", "chunk_status", "type_counts", "transfer_log"):
        spark.sql(f"DROP TABLE IF EXISTS study_db.{name}")


def test_export_options_on_a_table(spark, folder):
    rows = [(1, "arm_1", "2024-01-01", 5, "s"), (2, "arm_2", "2024-02-01", 6, "s")]
    df = spark.createDataFrame(
        rows, "record_id int, p_event_name string, at string, a int, p_survey_identifier string"
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    d = spark.createDataFrame([("record_id", "f", 0), ("a", "f", 1), ("at", "g", 2)],
                              "field_name string, form_name string, position int")
    options = TR.ExportOptions(
        modified_after=datetime(2024, 1, 15), events=("arm_2",), forms=("f",), filter_logic="a > 5"
    )
    source = TableSource(df, d, "record_id", options=options, modified_column="at")
    out = source.records()
    assert out.columns == ["record_id", "a"] and [r["record_id"] for r in out.collect()] == [2]
    assert [r[0] for r in source.record_ids().collect()] == ["2"]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode() if isinstance(text, str) else text)


def test_folder_source(spark, tmp_path, folder):
    base = tmp_path / "export"
    write(base / "records" / "a.csv", "﻿record_id,v\n1, 10 \n2,NA\n\n")
    write(base / "records" / "b.csv", 'w,record_id\n"x, ""y""\nz",3\n')
    write(base / "records" / "c.csv", "record_id,v\n4,1,too,many\n")
    write(base / "metadata.csv", "field_name,form_name,field_label\nrecord_id,f,ID\nv,f,Value\n")
    project = Project(spark, root=folder + "/p", audit_log=None)
    result = ingest(project, FolderSource(spark, str(base), "record_id"))
    assert not result
    got = {r["record_id"]: (r["v"], r["w"]) for r in project.records().collect()}
    assert got == {1: (10, None), 2: (None, None), 3: (None, 'x, "y"\nz')}
    assert project.log().filter("message LIKE 'Unable to read%c.csv%'").count() == 1


def test_folder_reader_pushes_filters_and_fails_fast(spark, tmp_path):
    write(tmp_path / "a.csv", "id,v\n1,x\n2,y\n,z\n")
    df = read_folder(spark, str(tmp_path))
    assert [r["v"] for r in df.filter("id = '2'").collect()] == ["y"]
    assert [r["v"] for r in df.filter("id IN ('1', '2')").orderBy("id").collect()] == ["x", "y"]
    assert [r["v"] for r in df.filter("id IS NULL").collect()] == ["z"]
    assert read_folder(spark, str(tmp_path), fields="v,absent").columns == ["v", "absent"]
    write(tmp_path / "b.csv", "id,v\n1,2,3\n")
    with pytest.raises(Exception):
        read_folder(spark, str(tmp_path)).collect()


def test_csv_stream_small_blocks():
    text = "a,b\n" + "".join(f'{i}," v{i}\t"\n' for i in range(5000))
    batches = list(csv_batches(io.BytesIO(text.encode()), block_bytes=1024))
    assert sum(b.num_rows for b in batches) == 5000 and len(batches) > 1
    assert batches[0].column(1)[0].as_py() == "v0"
    assert read_header(io.BytesIO(b"")) == [] and list(csv_batches(io.BytesIO(b""))) == []
    assert read_header(io.BytesIO(b'"a\nb",c\n1,2\n')) == ["a\nb", "c"]


def test_form_post_retries_and_hides_the_token(monkeypatch):
    calls, slept = [], []

    def urlopen(request, timeout):
        calls.append(request.data)
        if len(calls) < 3:
            raise urllib.error.HTTPError(request.full_url, 504, "timeout", {}, None)
        return io.BytesIO(b"a\n1\n")

    monkeypatch.setattr(TR.urllib.request, "urlopen", urlopen)
    monkeypatch.setattr(TR.time, "sleep", slept.append)
    post = TR.FormPost("https://example.org/api/", "SECRET")
    assert post({"content": "record"}).read() == b"a\n1\n"
    assert len(calls) == 3 and b"token=SECRET" in calls[0] and slept == [1.0, 2.0]
    assert "SECRET" not in repr(post)
    assert pickle.loads(cloudpickle.dumps(post))._url == "https://example.org/api/"
    calls.clear()
    with pytest.raises(urllib.error.HTTPError):
        TR.FormPost("https://example.org/api/", "SECRET", max_retries=1)({})
    params = TR.ExportOptions(fields=("a", "b"), survey_fields=True).record_params()
    assert params["fields"] == "a,b" and params["exportSurveyFields"] == "true"
    assert params["rawOrLabel"] == "raw" and params["dateRangeBegin"] == ""


def test_lookup_paths_agree(spark):
    rows = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None)
        .otherwise(F.col("id") % 50).cast("int").alias("k"),
        F.col("id").alias("v"),
    )
    keyed = spark.createDataFrame(
        [(0, "zero"), (None, "none"), (5, "five"), (99, "unused")], "k int, label string"
    )
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = attach(rows, keyed, ["k"], how)
        large = attach(rows, keyed, ["k"], how, rows=0)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    hot = {r["k"] for r in hot_keys(rows, ["k"]).collect()}
    assert hot >= {0, None} and len(hot) < 16
    assert not fits_broadcast(rows, rows=10) and fits_broadcast(keyed)
    assert not fits_broadcast(keyed, size=8)


def test_copies_of_one_row_are_spread(spark):
    copies = spark.range(0, 8000, numPartitions=16).select(F.lit(1).alias("k"))
    salts = copies.select(F.pmod(row_spread(copies), F.lit(32)).alias("s")).distinct().count()
    assert salts > 8
    keyed = spark.createDataFrame([(1, "one")], "k int, label string")
    joined = attach(copies, keyed, ["k"], rows=0)
    assert joined.groupBy("label").count().collect()[0]["count"] == 8000
    ordered = sort_spread(copies, F.col("k"))
    assert ordered.columns == ["k"] and ordered.count() == 8000


def test_shared_folder(spark, monkeypatch):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Context:
        master, applicationId = "yarn", "app-1"

    class Cluster:
        sparkContext = Context()

    class Conf:
        @staticmethod
        def get(name, default=None):
            return default

    Cluster.conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())
    Context.master, Context.getCheckpointDir = "local[2]", staticmethod(lambda: "set")
    assert session.shared_dir(Cluster()) == session.shared_dir(Cluster())


def test_numbering_is_gapless(spark):
    df = spark.range(0, 3210, numPartitions=7).select((F.col("id") * 37 % 3210).alias("id"))
    got = C.number_rows(df, "id").collect()
    assert sorted(r["row_position"] for r in got) == list(range(1, 3211))
    assert all(r["row_position"] == r["id"] + 1 for r in got)
    assert C.number_rows(df.limit(0), "id").count() == 0
    sizes = C.assign_chunks(df.union(df), "id", 100).groupBy("chunk").count().collect()
    assert len(sizes) == 33 and max(r["count"] for r in sizes) == 100


def test_outcomes(spark):
    def status(*rows):
        return C.tallies(spark.createDataFrame(list(rows), "chunk int, n_rows int, status string"))

    good = C.outcome(status((1, 5, "SUCCESS"), (2, 3, "SUCCESS"))).first()
    assert good["success"] and good["rows"] == 8 and good["message"].startswith("Transfer completed")
    bad = C.outcome(status((1, 5, "SUCCESS"), (2, 0, "ERROR"))).first()
    assert not bad["success"] and "1 of 2 chunks successful, 1 failed" in bad["message"]
    empty = spark.createDataFrame([], "chunk int, n_rows int, status string")
    none = C.outcome(C.tallies(empty)).first()
    assert not none["success"] and none["message"] == "Transfer of nothing"


def test_log_status_scopes(spark):
    rows = [
        (datetime(2024, 1, 1), "INFO", "Transfer started"),
        (datetime(2024, 1, 2), "ERROR", "x"),
        (datetime(2024, 1, 3), "INFO", "Transfer started"),
        (datetime(2024, 1, 4), "INFO", "Transfer completed in 3s"),
    ]
    log = spark.createDataFrame(rows, J.JOURNAL_SCHEMA)
    assert J.transfer_status(log).first()["status"] == "resume_with_errors"
    assert J.transfer_status(J.since_last_start(log)).first()["status"] == "complete"


def test_audit_days(spark):
    windows = day_windows_between(spark, date(2024, 2, 28), date(2024, 3, 1)).collect()
    assert [str(w["day"]) for w in windows] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert str(windows[1]["end_time"]) == "2024-02-29 23:59:59"
    log = spark.createDataFrame(
        [("2024-03-01 23:59:59.5",), ("2024-03-02 00:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("timestamp"))
    assert audit_range(log, "2024-03-01", "2024-03-01").count() == 1


def test_stream_resume(spark, tmp_path):
    drop, out, state = (str(tmp_path / n) for n in ("drop", "out", "state"))

    def load():
        land_available(stream_exports(spark, drop, ["id", "v"]), out, state)
        return spark.read.parquet(out).count()

    write(tmp_path / "drop" / "a.csv", "id,v\n1,x\n2,NA\n")
    assert load() == 2 and load() == 2
    write(tmp_path / "drop" / "b.csv", "id,v\n3,z\n")
    assert load() == 3
    assert spark.read.parquet(out).filter("v IS NULL").count() == 1


def test_csv_headers_are_checked(spark, tmp_path):
    write(tmp_path / "drop" / "a.csv", "v,id\nx,1\n")
    with pytest.raises(Exception, match="header|CSV"):
        out, state = str(tmp_path / "out"), str(tmp_path / "state")
        land_available(stream_exports(spark, str(tmp_path / "drop"), ["id", "v"]), out, state)


def test_few_files_are_spread_by_their_size(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/records"
    spark.range(20_000).selectExpr("id", "id / 3 AS weight").coalesce(1).write.parquet(path)
    records = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert session.spread_if_few(records).rdd.getNumPartitions() == cores
    monkeypatch.setattr(session, "SPREAD_BYTES", 2048)
    spread = session.spread_if_few(records)
    assert spread.rdd.getNumPartitions() > 4 * cores
    assert spread.count() == 20_000
    assert TableSource(records, None, "id").fetch(None, True).rdd.getNumPartitions() > 4 * cores
