"""The stand-in service: a request opens its own rows, and its answer is made as it is read."""

import glob
import io
import sys
import threading

import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle

from formlake import Project, RequestSource, ingest
from formlake.sources import file_answers as A
from formlake.sources.ahead import made_ahead
from formlake.sources.csv_stream import csv_batches
from formlake.sources.requests import TOLD, chunk_requests, run_requests

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ids(stream):
    return pacsv.read_csv(
        io.BytesIO(stream.read()), convert_options=pacsv.ConvertOptions(column_types={"id": "string"})
    )["id"].to_pylist()


def test_a_request_reads_the_files_of_its_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "BATCH_ROWS", 64)
    rows = spark.range(4000).selectExpr("id % 1000 AS id", "id AS visit", "id / 4 AS weight").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of few rows
    try:
        answers = A.write_answers(rows, "id", f"{tmp_path}/answers")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ends = []
    for file in glob.glob(f"{tmp_path}/answers/*.parquet"):
        found = pq.read_table(file)["id"].to_pylist()
        assert found == sorted(found)
        ends.append((found[0], found[-1]))
    ends.sort()
    assert len(ends) > 1 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))

    service = A.FileAnswers(answers)
    wanted = sorted(str(i) for i in range(1000))[300:340]
    got = _ids(service({"content": "record", "records": ",".join(wanted)}))
    assert sorted(got) == sorted(wanted * 4)
    assert sorted(_ids(service({"content": "record"}))) == sorted(str(i % 1000) for i in range(4000))
    assert service({"content": "record", "records": "none,such"}).read().strip() == b'"id","visit","weight"'


def test_an_answer_is_made_as_it_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "BATCH_ROWS", 64)
    answers = A.write_answers(spark.range(4000).selectExpr("id", "id AS visit"), "id", f"{tmp_path}/answers")
    pieces = A.FileAnswers(answers)._lines(["id"], None)
    assert len(list(pieces)) > 4000 // 64


class Listing:
    """Answers with one text, or not at all."""

    def __init__(self, text):
        self.text = text

    def __call__(self, params):
        if self.text is None:
            raise OSError("no identifiers")
        return io.BytesIO(self.text.encode())


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("id,visit\n1,9\n2,9\n1,9\n,7\n1,9\n", {"1": 3, "2": 1, "7": 1}),
        ("other\n1\n2\nNA\n1\n", {"1": 2, "2": 1, None: 1}),
        ("id\n", {}),
        ("", {}),
    ],
)
def test_listed_ids_are_counted(spark, text, wanted):
    source = RequestSource(spark, Listing(text), "id")
    counted = source.counted_ids()
    assert {r["id"]: r["n_rows"] for r in counted.collect()} == wanted
    once = source.record_ids().groupBy("id").count()
    assert {r["id"]: r["count"] for r in once.collect()} == wanted


def test_counts_of_listed_ids_are_spread(spark):
    plan = RequestSource(spark, Listing("id\n1\n"), "id").counted_ids()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" in plan  # not one task for all
    with pytest.raises(Exception, match="OSError: no identifiers"):
        RequestSource(spark, Listing(None), "id").counted_ids().collect()


def test_requests_land_alike_with_and_without_the_jvm(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id % 500 AS id", "id AS visit", "if(id % 3 = 0, null, 'a \"b\", c') AS note")
    answers = A.write_answers(rows, "id", f"{tmp_path}/answers")
    found = []
    for own in (True, False):
        source = RequestSource(spark, A.FileAnswers(answers, fail_every=5), "id", parallel=2, per_task=2)
        source.takes_sink = own
        project = Project(spark, root=f"{tmp_path}/p{own}", record_id="id", audit_log=None)
        result = ingest(project, source, chunk_size=30)
        assert result.n_chunks == 17 and 0 < result.failed_chunks < 17
        raw = project.read(project.raw).drop("_seconds", "_run")
        found.append((raw.schema.simpleString(), sorted(map(str, raw.collect())), result.failed_chunks, result.rows))
    assert found[0] == found[1]


def test_tasks_get_equally_many_requests(spark):
    """Rows dealt round by round from several partitions once left some tasks with twice the requests of others."""
    chunks = spark.range(0, 320, 1, 7).selectExpr("cast(id AS string) AS id", "cast(17 + id % 16 AS int) AS chunk")

    def counting(batches):
        yield pa.RecordBatch.from_arrays([pa.array([str(sum(b.num_rows for b in batches))])], names=[TOLD])

    requests = chunk_requests(chunks.repartition(5), "id", {"content": "record"})
    told = run_requests(requests, Listing("id\n1\n"), ["id"], 4, sink=counting)
    assert [r[0] for r in told.collect()] == ["8"] * 4  # each request gives a row and a status row


def test_made_ahead():
    assert list(made_ahead(iter(range(1000)))) == list(range(1000)) and list(made_ahead(iter(()))) == []

    def breaks():
        yield 1
        raise OSError("lost")

    found = made_ahead(breaks())
    assert next(found) == 1
    with pytest.raises(OSError, match="lost"):
        next(found)
    made, before = [], threading.active_count()
    endless = made_ahead(made.append(i) or i for i in range(10**9))
    assert next(endless) == 0
    endless.close()
    assert len(made) <= 5 and threading.active_count() == before


def test_a_stream_read_ahead_gives_the_same_batches():
    text = "id,note\n" + "".join(f'{i},"a ""{i}""\n, b"\n' for i in range(5000)) + "7\n"
    plain, ahead = ([b.to_pylist() for b in csv_batches(io.BytesIO(text.encode()), block_bytes=997, ahead=way)] for way in (False, True))
    assert plain == ahead and sum(map(len, plain)) == 5001
    before = threading.active_count()
    with pytest.raises(pa.ArrowInvalid):
        list(csv_batches(io.BytesIO(b"id,v\n" + b"1,2\n" * 5000 + b"1,2,3\n" * 5000), block_bytes=997, ahead=True))
    assert threading.active_count() == before
