"""What survives: killed workers, broken files, late days, long headers, many columns, odd keys."""

import io
import json
import os
import sys
from datetime import date

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_transfer import DICTIONARY, to_csv, write

from formlake import FolderSource, Project, RequestSource, TableSource, ingest, retry_failed
from formlake.operators import labels as L
from formlake.operators.lookup import attach, hot_keys, row_spread
from formlake.sources.csv_stream import csv_batches, read_header
from formlake.sources.export_folder import read_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Noted:
    """Answers from rows in memory, notes every request, and may kill its worker."""

    def __init__(self, rows, notes, deadly):
        self.rows, self.notes, self.deadly = rows, notes, deadly

    def __call__(self, params):
        with open(self.notes, "a") as notes:
            notes.write(json.dumps(params) + "\n")
        if params["content"] == "metadata":
            return to_csv(DICTIONARY, ["field_name", "form_name", "field_label"])
        if "records" not in params:
            return to_csv(self.rows, ["record_id"])
        wanted = set(params["records"].split(","))
        if len(wanted) > 1 and os.path.exists(self.deadly) and "080" in wanted:
            os._exit(7)
        return to_csv([r for r in self.rows if r["record_id"] in wanted], ["record_id", "v"])


def asked(notes):
    with open(notes) as lines:
        return [json.loads(line) for line in lines]


def test_waves_survive_a_killed_worker(spark, tmp_path, folder):
    rows = [{"record_id": f"{i:03d}", "v": str(i)} for i in range(1, 101)]
    notes, deadly = str(tmp_path / "notes"), tmp_path / "deadly"
    deadly.write_text("")
    source = RequestSource(spark, Noted(rows, notes, str(deadly)), parallel=2, per_task=2)
    project = Project(spark, root=folder + "/p", audit_log=None)
    first = ingest(project, source, chunk_size=5)
    assert not first and first.n_chunks == 20 and first.failed_chunks == 4 and first.rows == 80
    assert project.log().filter("type = 'ERROR' AND message LIKE 'Chunks 13 to 16: lost%'").count() == 1
    singles = [p for p in asked(notes) if p["content"] == "metadata" or "records" not in p]
    assert len(singles) == 2  # one answer each, not one more for its header

    deadly.unlink()
    os.truncate(notes, 0)
    assert retry_failed(project, source, chunk_size=5).rows == 100
    again = [p["records"].split(",") for p in asked(notes) if "," in p.get("records", "")]
    assert sorted(i for ids in again for i in ids) == [f"{i:03d}" for i in range(61, 81)]
    assert project.records().select("record_id").distinct().count() == 100


def test_rows_without_an_id_never_land(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "record_id int, v string")
    project = Project(spark, root=folder + "/p", audit_log=None)
    assert ingest(project, TableSource(rows, None, "record_id")).rows == 1
    more = rows.union(spark.createDataFrame([(2, "d"), (None, "e")], rows.schema))
    assert ingest(project, TableSource(more, None, "record_id"), refresh=True).rows == 2
    told = [r["message"] for r in project.log().filter("message LIKE '%left out'").collect()]
    assert [m.split()[2] for m in told] == ["2", "3"]


def test_a_broken_file_is_never_a_success(spark, tmp_path, folder):
    base = tmp_path / "export"
    write(base / "records" / "a.csv", "record_id,v\n1,10\n2,20\n")
    write(base / "records" / "b.csv", "record_id,v\n1,11\n3,30\nx,1,2\n")
    write(base / "metadata.csv", "field_name,form_name\nrecord_id,f\nv,f\n")
    project = Project(spark, root=folder + "/p", audit_log=None)
    for _ in range(3):
        assert not ingest(project, FolderSource(spark, str(base), "record_id"), refresh=True)
        assert sorted(r["v"] for r in project.records().collect()) == [10, 20]
    write(base / "records" / "b.csv", "record_id,v\n1,11\n3,30\n")
    assert ingest(project, FolderSource(spark, str(base), "record_id"), refresh=True)
    assert sorted(r["v"] for r in project.records().collect()) == [10, 11, 20, 30]


def test_failing_load_leaves_an_error_row(spark, folder):
    rows = spark.createDataFrame([(1, "a")], "record_id int, v string")
    project = Project(spark, root=folder + "/p", audit_log=None)
    with pytest.raises(ValueError):
        ingest(project, TableSource(rows, None, "record_id"), overflow="wrap")
    assert project.log().filter("type = 'ERROR' AND message LIKE 'Transfer broken off%'").count() == 1


@pytest.mark.parametrize("catalog", [False, True])
def test_refresh_replaces_only_its_days(spark, folder, catalog):
    stamps = [(f"2024-01-{d:02d} 10:00:00", "u") for d in range(1, 31)]
    log = spark.createDataFrame(stamps, "timestamp string, username string")
    source = TableSource(spark.range(2).withColumnRenamed("id", "record_id"), None, "record_id", audit=log)
    spark.sql("CREATE DATABASE IF NOT EXISTS audit_db")
    project = Project(spark, database="audit_db") if catalog else Project(spark, root=folder + "/p")
    ingest(project, source, audit_begin=date(2024, 1, 1), audit_end=date(2024, 1, 30))
    ingest(project, source, audit_begin=date(2024, 1, 3), audit_end=date(2024, 1, 4), refresh=True)
    assert project.audit().count() == 30
    assert project.audit().select("timestamp").distinct().count() == 30
    if catalog:
        spark.sql("DROP DATABASE audit_db CASCADE")


def test_header_of_any_length():
    names = [f"column_number_{i}_{'x' * 40}" for i in range(32_000)]
    text = (",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n").encode()
    assert len(text) > 1 << 20 and read_header(io.BytesIO(text)) == names
    batches = list(csv_batches(io.BytesIO(text)))
    assert batches[0].schema.names == names and batches[0].num_rows == 1
    quoted = b'"a\nb","c ""d"", e"\n1,2\n'
    assert read_header(io.BytesIO(quoted)) == ["a\nb", 'c "d", e']


def test_folder_ranges_reach_the_reader(spark, tmp_path):
    write(tmp_path / "a.csv", "id,at\n1,2024-01-01\n2,2024-02-01\n3,\n4,2024-03-01\n")
    df = read_folder(spark, str(tmp_path)).filter("at >= '2024-01-15' AND at < '2024-03-01'")
    assert [r["id"] for r in df.collect()] == ["2"]


def test_guard_scans_once_at_any_width(spark, tmp_path):
    seen = str(tmp_path / "scans")

    def note(batches):
        for batch in batches:
            with open(seen, "a") as scans:
                scans.write("x" * batch.num_rows)
            yield batch

    columns = [F.when(F.col("id") == i % 7, F.lit("1")).otherwise("z").alias(f"c{i}") for i in range(600)]
    wide = spark.range(20).coalesce(1).select(*columns)
    wide = wide.mapInArrow(note, wide.schema)
    found = L.coded_columns(wide, {f"c{i}": ["1"] if i % 2 else ["absent"] for i in range(600)})
    assert found == {f"c{i}": bool(i % 2) for i in range(600)}
    with open(seen) as scans:
        assert len(scans.read()) == 20


def test_code_lists_agree_on_both_sides_of_the_bound(spark):
    cells = spark.createDataFrame([(str(i),) for i in range(0, 300, 7)], "record_id string").withColumn(
        "v", F.col("record_id")
    )
    out = []
    for n in (L.LITERAL_CODES - 1, L.LITERAL_CODES + 1):
        choices = " | ".join(f"{i}, label {i}" for i in range(n))
        study = spark.createDataFrame(
            [(0, "record_id", "f", "text", "", None), (1, "v", "f", "radio", "", choices)],
            "position int, field_name string, form_name string, field_type string, field_label string, "
            "select_choices_or_calculations string",
        )
        rows = L.label(cells, study).filter(F.col("record_id").cast("int") < L.LITERAL_CODES - 1)
        out.append(sorted((r["record_id"], r["v"]) for r in rows.collect()))
    assert out[0] == out[1] and ("7", "label 7") in out[0]


def test_first_label_wins(spark):
    codes = spark.createDataFrame([(1, "zebra", 1), (1, "apple", 2), (2, "b", 3)], "code int, label string, at int")
    cells = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    for df in (L.decode_by_table(cells, "v", codes.coalesce(1)), L.decode_by_table(cells, "v", codes, order="at")):
        assert sorted(r["v"] for r in df.collect()) == ["3", "b", "zebra"]


def test_hot_keys_get_salts_by_their_share(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.struct(F.create_map(F.lit("a"), F.col("id"))).alias("nested"), "id",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [(r["k"], r["_salts"]) for r in hot_keys(rows, ["k"]).collect()] == [(0, parts // 2)]
    keyed = spark.range(4000).select(F.col("id").alias("k"), F.col("id").alias("value"))
    joined = attach(rows, keyed, ["k"], rows=0)
    assert joined.count() == 4000 and joined.filter("value = k").count() == 4000
    assert rows.select(row_spread(rows)).distinct().count() > 3000
