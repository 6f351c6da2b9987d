"""CSV streams and byte ranges: records of any length and shape, against the csv module."""

import csv
import io
import random
from collections import Counter

import pytest
from pyarrow import fs

from formlake import Project, ingest
from formlake.plans.catalogue import transfer
from formlake.sources import csv_ranges
from formlake.sources.csv_ranges import plan_slices, scan_range
from formlake.sources.csv_stream import SHORT_ROWS, HeaderError, csv_batches, read_header, record_blocks
from formlake.sources.export_folder import plan_folder, read_folder
from formlake.sources.projects import FolderSource


def cells(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


def cleaned(rows):
    return [tuple(None if c.strip(" \t") in ("", "NA") else c.strip(" \t") for c in r) for r in rows]


def random_csv(seed, rows=200, end="\n"):
    pick = random.Random(seed)
    parts = ["a", "b c", 'say "hi"', "line\nbreak", ",", "", "NA", " padded ", "\r\n", '"', "x" * 50, "é漢😀"]
    table = [[f"{i}", *("".join(pick.choices(parts, k=pick.randint(0, 3))) for _ in range(3))] for i in range(rows)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "one", "two\nlines", "three"])
    writer.writerows(table)
    return out.getvalue().encode(), table


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_stream_equals_the_csv_module(end, block):
    data, table = random_csv(block, end=end)
    got = cells(csv_batches(io.BytesIO(data), block_bytes=block))
    assert Counter(got) == Counter(cleaned(table))
    assert b"".join(record_blocks(io.BytesIO(data), block)) == data
    assert read_header(io.BytesIO(data)) == ["id", "one", "two\nlines", "three"]


def test_cells_longer_than_a_block():
    long = "word, \"quoted\"\n" * 1_500_000  # 22 MB
    out = io.StringIO()
    csv.writer(out).writerows([["id", "text"], ["1", "before"], ["2", long], ["3", "after"]])
    got = cells(csv_batches(io.BytesIO(out.getvalue().encode())))
    assert [g[0] for g in got] == ["1", "2", "3"] and got[1][1] == long.strip(" \t") and got[2][1] == "after"


def test_quotes_inside_cells():
    data = b'id,text\n1,5" wide\n2,"quoted, ""x"""\n3,a"b"c\n4,"two\nlines"\n5,6" high\n'
    for block in (5, 1 << 20):
        got = cells(csv_batches(io.BytesIO(data), block_bytes=block))
        assert got == [("1", '5" wide'), ("2", 'quoted, "x"'), ("3", 'a"b"c'), ("4", "two\nlines"), ("5", '6" high')]


def test_short_rows_are_filled_and_counted():
    data = b'id,a,b\n1,x,y\n2,x\n3\n4,"two\nlines"\n5,p,q\n'
    notes = Counter()
    got = cells(csv_batches(io.BytesIO(data), notes=notes))
    assert sorted(got) == [("1", "x", "y"), ("2", "x", None), ("3", None, None), ("4", "two\nlines", None), ("5", "p", "q")]
    assert notes == {SHORT_ROWS: 3}
    some = cells(csv_batches(io.BytesIO(data), ["b", "id"]))
    assert Counter(some) == Counter([("y", "1"), (None, "2"), (None, "3"), (None, "4"), ("q", "5")])


def test_headers():
    for data in (b"\xff\xfe,b\n1,2\n", b"a,a\n1,2\n", b'"a\n1,2\n'):
        with pytest.raises(HeaderError):
            list(csv_batches(io.BytesIO(data)))
    bom = b'\xef\xbb\xbf"a",b\r1,2\r'
    assert read_header(io.BytesIO(bom)) == ["a", "b"] and cells(csv_batches(io.BytesIO(bom))) == [("1", "2")]
    assert read_header(io.BytesIO(b"\n\n")) == [] and cells(csv_batches(io.BytesIO(b"a,b\n"))) == []


@pytest.mark.parametrize("seed", range(6))
def test_ranges_are_scanned_for_both_cases(tmp_path, seed):
    data, _ = random_csv(seed, rows=60)
    path = tmp_path / "x.csv"
    path.write_bytes(data)
    store = fs.LocalFileSystem()
    size, step = len(data), random.Random(seed).choice([13, 50, 211])
    inside, starts = 0, []
    with store.open_input_file(str(path)) as file:
        for begin in range(0, size, step):
            quotes, out, inn, sound_out, sound_in = scan_range(file, size, begin, min(size, begin + step))
            assert (sound_in if inside else sound_out)
            starts.append(0 if not begin else (inn if inside else out))
            inside ^= quotes & 1
    ends, quoted = {0}, False
    for i, sign in enumerate(data):
        quoted ^= sign == 34
        if sign in (10, 13) and not quoted:
            ends.add(i + 1)
    assert all(s is None or s in ends for s in starts)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_slices_equal_the_stream(spark, tmp_path, end):
    data, table = random_csv(3, rows=3000, end=end)
    (tmp_path / "large.csv").write_bytes(data)
    (tmp_path / "small.csv").write_bytes(b"id,other\ns,o\n")
    (tmp_path / "stray.csv").write_bytes(b"id,one\n" + b'7,5" wide\n8,"a\nb"\n' * 2000)
    plan = plan_folder(spark, str(tmp_path), 16_000)
    whole = read_folder(spark, str(tmp_path), mode="isolate")
    cut = read_folder(spark, str(tmp_path), mode="isolate", plan=plan)
    assert plan.slices.filter("file like '%stray%'").count() == 1
    assert plan.slices.filter("file like '%large%'").count() > 5
    assert cut.columns == whole.columns
    rows = lambda df: Counter(map(str, df.filter("_status is null").collect()))
    assert rows(cut) == rows(whole) and sum(rows(cut).values()) == 3000 + 1 + 4000
    told = {r["_file"].rsplit("/", 1)[-1]: r["n"] for r in cut.filter("_status = 'SUCCESS'").groupBy("_file").agg({"_rows": "sum"}).withColumnRenamed("sum(_rows)", "n").collect()}
    assert told == {"large.csv": 3000, "small.csv": 1, "stray.csv": 4000}
    fields = read_folder(spark, str(tmp_path), mode="isolate", plan=plan, fields="one,absent")
    assert fields.filter("_status is null").count() == 7001 and fields.columns[:2] == ["one", "absent"]


def test_slices_of_a_tiny_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"id\n1\n")
    assert plan_folder(spark, str(tmp_path)).slices is None
    store_of = fs.LocalFileSystem
    slices = plan_slices(spark, [(str(tmp_path / "a.csv"), 5, ["id"])], store_of, 2).collect()
    assert sorted((r["begin"], r["end"]) for r in slices) == [(0, 3), (3, 5)]


def test_odd_files_land_or_are_told(spark, tmp_path, folder):
    records = tmp_path / "records"
    records.mkdir()
    (tmp_path / "metadata.csv").write_bytes(b"field_name,form_name\nid,main\n")
    (records / "broken.csv").write_bytes(b"\xff\xfeid,\x00v\n1,2\n")
    (records / "cr.csv").write_bytes(b"id,v\r10,a\r11,b\r")
    (records / "short.csv").write_bytes(b"id,v\n20,a\n21\n")
    (records / "long.csv").write_bytes(b"id,v\n30,a,b,c\n")
    large = b"id,v\n" + b"".join(b'4%05d,"x\ny"\n' % i for i in range(500))
    (records / "large.csv").write_bytes(large)
    project = Project(spark, root=f"{folder}/p", record_id="id", audit_log=None)
    result = ingest(project, FolderSource(spark, str(tmp_path), "id", range_bytes=2048))
    assert not result and project.records().count() == 2 + 2 + 500
    log = [(r["type"], r["message"]) for r in project.log().collect()]
    assert sum(t == "ERROR" and "Unable to read" in m for t, m in log) == 2
    assert any(t == "WARNING" and "short.csv" in m and f"1 {SHORT_ROWS}" in m for t, m in log)
    (records / "broken.csv").write_bytes(b"id,v\n1,2\n")
    (records / "long.csv").write_bytes(b"id,v\n30,a\n")
    assert ingest(project, FolderSource(spark, str(tmp_path), "id", range_bytes=2048), refresh=True)
    assert project.records().count() == 2 + 2 + 500 + 2


def test_a_slice_that_fails_keeps_its_file_out(spark, tmp_path, folder):
    records = tmp_path / "records"
    records.mkdir()
    (tmp_path / "metadata.csv").write_bytes(b"field_name,form_name\nid,main\n")
    good = [b"%d,a\n" % i for i in range(400)]
    (records / "large.csv").write_bytes(b"id,v\n" + b"".join(good[:300]) + b"9999,a,b,c\n" + b"".join(good[300:]))
    (records / "other.csv").write_bytes(b"id,v\n7000,a\n")
    project = Project(spark, root=f"{folder}/p", record_id="id", audit_log=None)
    assert not ingest(project, FolderSource(spark, str(tmp_path), "id", range_bytes=2048))
    assert project.records().count() == 1
    (records / "large.csv").write_bytes(b"id,v\n" + b"".join(good))
    assert ingest(project, FolderSource(spark, str(tmp_path), "id", range_bytes=2048), refresh=True)
    assert project.records().count() == 401


def test_a_task_takes_many_short_slices(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("id,note\n" + "".join(f'{i},"a, {i}\nb"\n' for i in range(3000)))
    plan = plan_folder(spark, str(tmp_path), 256)
    few = 4 * spark.sparkContext.defaultParallelism
    assert plan.slices.count() > 2 * few
    rows = read_folder(spark, str(tmp_path), plan)
    tasks = rows.rdd.getNumPartitions()
    assert tasks <= few + 1  # one more for the small files
    assert sorted((int(r["id"]), r["note"]) for r in rows.collect()) == [(i, f"a, {i}\nb") for i in range(3000)]
    monkeypatch.setattr(csv_ranges, "TASK_BYTES", 512)  # more tasks where the bytes ask for them
    assert read_folder(spark, str(tmp_path), plan).rdd.getNumPartitions() > tasks


def test_export_files_are_bounded(spark, tmp_path):
    spark.range(200).selectExpr("id AS doc_id", "'en' AS lang", "repeat('text ', 20) AS text").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    transfer._document_files(spark, str(tmp_path), f"{tmp_path}/four")
    transfer._document_files(spark, str(tmp_path), f"{tmp_path}/more", file_bytes=2000)
    assert len(list((tmp_path / "four").glob("*.csv"))) == 4
    assert len(list((tmp_path / "more").glob("*.csv"))) == 10
    assert read_folder(spark, f"{tmp_path}/more").count() == 200
