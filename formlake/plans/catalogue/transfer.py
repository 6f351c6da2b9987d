"""Record IDs, chunks and the resumable load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from formlake.operators import chunks as C
from formlake.operators import ids as I
from formlake.operators.narrowing import as_text
from formlake.plans.catalogue.projects import (
    AUDIT_SQL,
    audit_log,
    customer_dictionary,
    customer_project,
    lineitem_dictionary,
)
from formlake.plans.catalogue.registry import query, table
from formlake.sources.file_answers import FileAnswers, write_answers, write_file
from formlake.plans.ingest import TransferError, ingest, pending_record_ids as ids_to_load
from formlake.project import Project
from formlake.session import scratch_path
from formlake.sources.export_folder import read_folder
from formlake.sources.projects import FolderSource, RequestSource, TableSource
from formlake.sources.transport import ExportOptions

_CHUNKS_SQL = """
SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / {size}.0) AS INTEGER) AS chunk
FROM (SELECT DISTINCT o_orderkey FROM orders)
"""

# Two orders per chunk, so that some chunks' orders have no line items at all.
_SMALL = 2
_STATUS_SQL = f"""
SELECT chunk, count(*) AS n_ids, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_rows,
       CASE WHEN sum(coalesce(n, 0)) > 0 THEN 'SUCCESS' ELSE 'ERROR' END AS status
FROM ({_CHUNKS_SQL.format(size=_SMALL)}) c
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l
  ON c.o_orderkey = l.l_orderkey
GROUP BY chunk
"""

_LABEL_SQL = (
    "lpad(CAST(chunk AS VARCHAR), CAST(greatest(4, length(CAST(chunk AS VARCHAR))) AS INTEGER), '0')"
)

_TALLY_SQL = f"""
SELECT count(*) AS n_chunks, count_if(status = 'SUCCESS') AS successful_chunks,
       count_if(status = 'ERROR') AS failed_chunks,
       CAST(sum(CASE WHEN status = 'SUCCESS' THEN n_rows ELSE 0 END) AS BIGINT) AS rows
FROM ({_STATUS_SQL})
"""


def _orders(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))


def _small_chunks(spark, folder):
    return C.assign_chunks(_orders(spark, folder), "l_orderkey", _SMALL)


def _small_status(spark, folder, chunks):
    return C.delivered_status(table(spark, folder, "lineitem"), chunks, "l_orderkey")


@query("SELECT DISTINCT l_orderkey FROM lineitem")
def record_ids_distinct(spark, folder):
    return I.distinct_ids(table(spark, folder, "lineitem"), "l_orderkey")


@query("""
SELECT o_orderkey AS l_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def pending_record_ids(spark, folder):
    return I.pending_ids(_orders(spark, folder), table(spark, folder, "lineitem"), "l_orderkey")


@query("""
SELECT DISTINCT o_custkey AS id, 'missing' AS kind FROM orders
WHERE o_custkey NOT IN (SELECT l_partkey FROM lineitem)
UNION ALL
SELECT DISTINCT l_partkey, 'extra' FROM lineitem
WHERE l_partkey NOT IN (SELECT o_custkey FROM orders)
""")
def missing_extra_ids(spark, folder):
    source = table(spark, folder, "orders").select(F.col("o_custkey").alias("id"))
    landed = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("id"))
    return I.missing_and_extra(source, landed, "id")


@query(_CHUNKS_SQL.format(size=1000).replace("SELECT o_orderkey, CAST", "SELECT o_orderkey AS l_orderkey, CAST"))
def chunk_assignment(spark, folder):
    return C.assign_chunks(_orders(spark, folder), "l_orderkey")


@query(f"""
SELECT chunk, n_ids, n_rows, status,
       CASE WHEN status = 'SUCCESS'
         THEN 'Chunk ' || {_LABEL_SQL} || ': ' || CAST(n_rows AS VARCHAR) || ' rows'
         ELSE 'Chunk ' || {_LABEL_SQL} || ': failed, returned no data'
       END AS message
FROM ({_STATUS_SQL})
""")
def chunk_status(spark, folder):
    status = _small_status(spark, folder, _small_chunks(spark, folder))
    return C.chunk_messages(status).select("chunk", "n_ids", "n_rows", "status", "message")


@query(_TALLY_SQL)
def chunk_tallies(spark, folder):
    return C.tallies(_small_status(spark, folder, _small_chunks(spark, folder)))


@query(f"""
SELECT o_orderkey AS l_orderkey, chunk FROM ({_CHUNKS_SQL.format(size=_SMALL)})
WHERE chunk IN (SELECT chunk FROM ({_STATUS_SQL}) WHERE status = 'ERROR')
""")
def failed_record_ids(spark, folder):
    chunks = _small_chunks(spark, folder)
    return C.failed_ids(chunks, _small_status(spark, folder, chunks), "l_orderkey")


@query(f"""
SELECT n_chunks, successful_chunks, failed_chunks, rows, failed_chunks = 0 AS success,
       CASE WHEN failed_chunks = 0 THEN 'Transfer completed' ELSE 'Transfer incomplete' END
       || ' with ' || CAST(successful_chunks AS VARCHAR) || ' of ' || CAST(n_chunks AS VARCHAR)
       || ' chunks successful, ' || CAST(failed_chunks AS VARCHAR) || ' failed' AS message
FROM ({_TALLY_SQL})
""")
def transfer_outcome(spark, folder):
    return C.outcome(C.tallies(_small_status(spark, folder, _small_chunks(spark, folder))))


@query("""
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
""")
def transfer_end_to_end(spark, folder):
    """Longitudinal records landed as text, narrowed and read back; no row twice."""
    project = Project(spark, root=scratch_path(spark, "project"), record_id="l_orderkey")
    source = TableSource(
        table(spark, folder, "lineitem"),
        lineitem_dictionary(spark),
        "l_orderkey",
        audit=audit_log(spark, folder),
    )
    ingest(project, source, audit_begin=date(2024, 1, 1), audit_end=date(2024, 1, 31))
    return project.records()


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
""")
def resume_append(spark, folder):
    """A second load brings the records that appeared since the first."""
    orders = table(spark, folder, "orders")
    project = Project(
        spark, root=scratch_path(spark, "project"), record_id="o_orderkey", audit_log=None
    )
    first = orders.filter("o_orderdate < '1998-01-01'")
    ingest(project, TableSource(first, None, "o_orderkey"))
    ingest(project, TableSource(orders, None, "o_orderkey"), refresh=True)
    return project.records()


@query("""
SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE o_orderdate >= '1998-01-01'
""")
def pending_after_load(spark, folder):
    """What a second load would ask for, told from the index of landed IDs without the raw table."""
    orders = table(spark, folder, "orders")
    project = Project(spark, root=scratch_path(spark, "project"), record_id="o_orderkey", audit_log=None)
    ingest(project, TableSource(orders.filter("o_orderdate < '1998-01-01'"), None, "o_orderkey"))
    return ids_to_load(project, TableSource(orders, None, "o_orderkey"))


_VERSION_SQL = """
SELECT '{name}' AS version, '{kind}' AS type, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders
"""


@query(
    _VERSION_SQL.format(name="held", kind="varchar") + "WHERE o_orderdate < '1998-01-01' UNION ALL"
    + _VERSION_SQL.format(name="1", kind="varchar") + "WHERE o_orderdate < '1998-01-01' UNION ALL"
    + _VERSION_SQL.format(name="2", kind="bigint")
)
def published_versions(spark, folder):
    """A second load changes a column's type and so rewrites the table; readers keep what they had.

    The version before can still be read, and so can a DataFrame made before the second load.
    """
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "o_orderkey + 3000000000 AS big", "o_orderdate")
    project = Project(spark, root=scratch_path(spark, "project"), record_id="o_orderkey", audit_log=None)
    first = orders.filter("o_orderdate < '1998-01-01'")
    ingest(project, TableSource(first, None, "o_orderkey"))
    held = project.records()
    ingest(project, TableSource(orders, None, "o_orderkey"), refresh=True, overflow="bigint")
    seen = {"held": held}
    seen |= {str(n): project.records(version=n) for n in project.versions(project.data).numbers()}
    parts = [
        df.agg(
            F.lit(name).alias("version"), F.lit(dict(df.dtypes)["big"].replace("string", "varchar")).alias("type"),
            F.count("*").alias("n"), F.sum(F.col("big").cast("bigint") - 3_000_000_000).cast("bigint").alias("total"),
        )
        for name, df in seen.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""
WITH chunks AS (
  SELECT chunk, count(*) AS n FROM (
    SELECT CAST(ceil(row_number() OVER (ORDER BY c_custkey) / 100.0) AS INTEGER) AS chunk
    FROM customer) GROUP BY chunk),
figures AS (SELECT count(*) AS n, CAST(sum(n) AS VARCHAR) AS rows FROM chunks)
SELECT 'SUCCESS' AS type, 'Chunk ' || {_LABEL_SQL} || ': ' || CAST(n AS VARCHAR) || ' rows' AS message
FROM chunks
UNION ALL
SELECT 'INFO', unnest([
  'Transfer started', 'Dictionary: asking the source', 'Dictionary: stored',
  'Record IDs: asking the source', 'Record IDs: ' || rows || ' to load',
  'Chunks: ' || CAST(n AS VARCHAR) || ' of at most 100 record IDs', 'Types: 9 columns profiled',
  'Type of record_id: INTEGER', 'Type of nation: INTEGER', 'Type of balance: DOUBLE',
  'Type of flag___1: INTEGER', 'Type of flag___2: INTEGER', 'Type of profile_complete: INTEGER',
  'Type of finance_and_risk_complete: INTEGER', 'Records: ' || rows || ' rows in the table',
  'Transfer completed with ' || CAST(n AS VARCHAR) || ' of ' || CAST(n AS VARCHAR)
    || ' chunks successful, 0 failed'])
FROM figures
""")
def transfer_log_of_load(spark, folder):
    """Entries a load writes: its stages, one per chunk and one per narrowed column."""
    project = Project(spark, root=scratch_path(spark, "project"), audit_log=None)
    source = TableSource(
        customer_project(spark, folder), customer_dictionary(spark, folder), "record_id"
    )
    ingest(project, source, chunk_size=100)
    timeless = F.regexp_replace("message", "completed in .* with", "completed with")
    return project.log().select("type", timeless.alias("message"))


_TYPED_LINEITEM = """
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
"""


@query(_TYPED_LINEITEM)
def transfer_requests(spark, folder):
    """Records asked for chunk by chunk; some chunks fail at first and are asked for again."""
    root = scratch_path(spark, "requests")
    answers = write_answers(table(spark, folder, "lineitem"), "l_orderkey", f"{root}/answers")
    project = Project(spark, root=f"{root}/project", record_id="l_orderkey", audit_log=None)
    size = max(50, table(spark, folder, "orders").count() // 60)
    failing = RequestSource(spark, FileAnswers(answers, fail_every=7), "l_orderkey", parallel=4)
    ingest(project, failing, chunk_size=size)
    ingest(project, RequestSource(spark, FileAnswers(answers), "l_orderkey", parallel=4), chunk_size=size)
    return project.records()


def _customer_files(spark, folder, path: str, files: int = 6):
    """Customers as CSV exports, some of each nation in every file."""
    rows = as_text(table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey"))
    parts = rows.repartitionById(files, F.pmod(F.col("c_custkey").cast("int"), F.lit(files)))
    parts.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


@query("""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey
FROM customer UNION ALL SELECT CAST(min(c_custkey) AS INTEGER), 'late visit', NULL FROM customer
""")
def folder_load_isolated(spark, folder):
    """One export file breaks half-way, is repaired, and holds more of a record that had landed."""
    root = scratch_path(spark, "isolated")
    _customer_files(spark, folder, f"{root}/export/records")
    first = table(spark, folder, "customer").agg(F.min("c_custkey")).first()[0]
    late = f'c_custkey,c_name,c_nationkey\n{first},late visit,\n'
    for name, text in (("late", late + "1,2,3,4,5\n"), ("metadata", "field_name,form_name\nc_custkey,main\n")):
        where = f"{root}/export/records/{name}.csv" if name == "late" else f"{root}/export/metadata.csv"
        write_file(spark, where, text)
    project = Project(spark, root=f"{root}/project", record_id="c_custkey", audit_log=None)
    for text in (None, None, late):  # unreadable in the first two runs
        if text:
            write_file(spark, f"{root}/export/records/late.csv", text)
        source = FolderSource(spark, f"{root}/export", "c_custkey")
        result = ingest(project, source, chunk_size=200, refresh=True)
        if bool(result) != bool(text):
            raise AssertionError("a load with an unreadable file must not end in success")
    return project.records()


_CELL = "nullif(nullif(trim({0}, ' ' || chr(9)), ''), 'NA')"
_DOCUMENT_CELLS = f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_CELL.format("lang")} AS lang, {_CELL.format("text")} AS text FROM documents
"""
_RANGE = 256 << 10
_EXACT = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
          "ignoreTrailingWhiteSpace": "false"}


_FILE_BYTES = 64 << 20


def _document_files(spark, folder, path: str, files: int = 4, file_bytes: int = _FILE_BYTES):
    """Documents as CSV exports; their texts hold line breaks, quotes and separators.

    There are ``files`` of them, and more where these would hold over ``file_bytes`` of text.
    """
    documents = table(spark, folder, "documents")
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files = max(files, -(-size // file_bytes))
    rows = as_text(documents.select("doc_id", "lang", "text"))
    parts = rows.repartitionById(files, F.pmod(F.crc32(F.col("doc_id").cast("binary")), F.lit(files)).cast("int"))
    parts.write.mode("overwrite").options(**_EXACT).csv(path)


@query(_DOCUMENT_CELLS)
def scan_split_exports(spark, folder):
    """A few large export files with line breaks in their cells, each read by many tasks."""
    path = scratch_path(spark, "split")
    _document_files(spark, folder, path)
    return read_folder(spark, path, range_bytes=_RANGE)


@query(f"""
SELECT doc_id, lang, length(text) AS length, md5(text) AS digest FROM (
  SELECT CAST(doc_id AS INTEGER) AS doc_id, lang, text FROM ({_DOCUMENT_CELLS})
  UNION ALL
  SELECT -1, 'long', {_CELL.format("repeat(text || chr(10), CAST(ceil(20e6 / (length(text) + 1)) AS BIGINT))")}
  FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents WHERE length(text) > 100)
  UNION ALL SELECT CAST(-2 - doc_id AS INTEGER), 'short', NULL FROM documents WHERE doc_id < 100
  UNION ALL SELECT -1000, 'warnings', 'log' FROM range(1) UNION ALL SELECT -1001, 'errors', 'log' FROM range(2)
)
""")
def folder_load_odd_files(spark, folder):
    """Documents beside a cell of 20 MB, short rows, a header that isn't text and a row too long.

    What can be read lands; the log has a warning of the short rows and an error for each of two files.
    """
    root = scratch_path(spark, "odd")
    _document_files(spark, folder, f"{root}/export/records")
    documents = table(spark, folder, "documents")
    first = documents.where("length(text) > 100").agg(F.min("doc_id")).first()[0]
    long = documents.where(F.col("doc_id") == first).selectExpr(
        "'-1' AS doc_id", "'long' AS lang", "repeat(text || '\n', cast(ceil(20e6 / (length(text) + 1)) AS int)) AS text"
    )
    long.coalesce(1).write.options(**_EXACT).csv(f"{root}/export/records/long")
    short = documents.where("doc_id < 100").selectExpr("concat(-2 - doc_id, ',short') AS `doc_id,lang,text`")
    bare = {"quote": "", "escapeQuotes": "false", "quoteAll": "false", "sep": "\t"}
    short.coalesce(1).write.options(header="true", **bare).csv(f"{root}/export/records/short")
    for name, text in (("wide", "doc_id,lang,text\n1,2,3,4\n"), ("twice", "doc_id,lang,lang\n1,2,3\n")):
        write_file(spark, f"{root}/export/records/{name}.csv", text)
    write_file(spark, f"{root}/export/metadata.csv", "field_name,form_name\ndoc_id,main\n")
    project = Project(spark, root=f"{root}/project", record_id="doc_id", audit_log=None)
    ingest(project, FolderSource(spark, f"{root}/export", "doc_id", range_bytes=_RANGE))
    rows = project.records().select("doc_id", "lang", F.length("text").cast("bigint").alias("length"), F.md5("text").alias("digest"))
    files = project.log().where("message like 'Unable to read%' or message like 'Read with remarks%'")
    told = files.selectExpr(
        "if(type = 'ERROR', -1001, -1000) AS doc_id", "if(type = 'ERROR', 'errors', 'warnings') AS lang",
        "3L AS length", "md5('log') AS digest",
    )
    return rows.unionByName(told)


@query("SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer")
def folder_record_ids(spark, folder):
    """Record IDs of an export folder; only that column of its files is parsed."""
    root = scratch_path(spark, "ids")
    _customer_files(spark, folder, f"{root}/export/records")
    write_file(spark, f"{root}/export/metadata.csv", "field_name,form_name\nc_custkey,main\n")
    return FolderSource(spark, f"{root}/export", "c_custkey").counted_ids().select("c_custkey")


@query(f"SELECT * FROM ({AUDIT_SQL})")
def audit_refresh_keeps_days(spark, folder):
    """The whole log is loaded, then two of its days again; the others stay."""
    log = audit_log(spark, folder)
    project = Project(spark, root=scratch_path(spark, "project"), record_id="c_custkey")
    source = TableSource(table(spark, folder, "nation").selectExpr("n_nationkey AS c_custkey"), None, "c_custkey", audit=log)
    for begin, end in ((date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 1, 5), date(2024, 1, 6))):
        ingest(project, source, audit_begin=begin, audit_end=end, refresh=True)
    return project.audit()


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice * 1000000 AS large, o_totalprice / 1e9 AS small
FROM orders
""")
def type_optimize_number_range(spark, folder):
    """Very large and very small numbers land as text and come back as the same doubles."""
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_totalprice * 1000000 AS large", "o_totalprice / 1e9D AS small"
    )
    project = Project(spark, root=scratch_path(spark, "project"), record_id="o_orderkey", audit_log=None)
    ingest(project, TableSource(orders, None, "o_orderkey"))
    return project.records()


@query("""
SELECT 'big' AS column_name, 'bigint' AS type, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders
UNION ALL SELECT 'o_orderkey', 'int', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
""")
def resume_with_options(spark, folder):
    """A resumed load with another option rewrites the columns whose type it decides anew."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "o_orderkey + 3000000000 AS big")
    project = Project(spark, root=scratch_path(spark, "project"), record_id="o_orderkey", audit_log=None)
    ingest(project, TableSource(orders, None, "o_orderkey"))
    ingest(project, TableSource(orders, None, "o_orderkey"), refresh=True, overflow="bigint")
    records = project.records()
    types = dict(records.dtypes)
    parts = [
        records.agg(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("type"), F.count("*").alias("n"),
            (F.sum(c) - F.lit(shift) * F.count("*")).cast("bigint").alias("total"),
        )
        for c, shift in (("big", 3_000_000_000), ("o_orderkey", 0))
    ]
    return parts[0].unionByName(parts[1])


@query("""
SELECT field_name, form_name, field_label FROM (VALUES
  ('l_orderkey', 'x', 'x')) AS t(field_name, form_name, field_label) WHERE false
UNION ALL SELECT '__record_id_name__', NULL, 'record_id'
UNION ALL SELECT * FROM (VALUES ('record_id', 'profile', 'Customer number'), ('name', 'profile', 'Name'),
  ('nation', 'profile', 'Home nation'), ('segment', 'profile', 'Market segment'),
  ('balance', 'finance_and_risk', 'Balance'), ('flag', 'finance_and_risk', 'Flags'))
""")
def metadata_of_load(spark, folder):
    """The stored dictionary of a load, loaded twice and there once."""
    project = Project(spark, root=scratch_path(spark, "project"), audit_log=None)
    source = TableSource(customer_project(spark, folder), customer_dictionary(spark, folder), "record_id")
    ingest(project, source)
    ingest(project, source, refresh=True)
    return project.metadata_table().select("field_name", "form_name", "field_label")


@query("""
SELECT true AS success, CAST(ceil(count(*) / 100.0) AS BIGINT) AS n_chunks, CAST(0 AS BIGINT) AS failed_chunks,
       count(*) AS n_rows, CAST(0 AS BIGINT) AS errors, true AS again
FROM customer
""")
def transfer_result(spark, folder):
    """What a load returns, and a second one at once."""
    project = Project(spark, root=scratch_path(spark, "project"), audit_log=None)
    source = TableSource(customer_project(spark, folder), customer_dictionary(spark, folder), "record_id")
    result = ingest(project, source, chunk_size=100)
    again = ingest(project, source, chunk_size=100)
    return project.log().agg(
        F.lit(bool(result)).alias("success"), F.lit(result.n_chunks).cast("bigint").alias("n_chunks"),
        F.lit(result.failed_chunks).cast("bigint").alias("failed_chunks"),
        F.lit(result.rows).cast("bigint").alias("n_rows"),
        F.count_if(F.col("type") == "ERROR").alias("errors"), F.lit(bool(again)).alias("again"),
    )


@query("SELECT 0 AS failed, count(*) AS entries FROM lineitem WHERE l_extendedprice < l_discount")
def transfer_of_nothing(spark, folder):
    """Filter logic that no record meets: the load looks at all, ends in an error and leaves no table."""
    project = Project(spark, root=scratch_path(spark, "project"), record_id="l_orderkey", audit_log=None)
    failed = 1
    try:
        nothing = ExportOptions(filter_logic="l_extendedprice < l_discount")
        ingest(project, TableSource(table(spark, folder, "lineitem"), None, "l_orderkey", options=nothing))
    except TransferError:
        failed = int(project.exists(project.data))
    entries = F.count_if(F.col("type") == "SUCCESS").alias("entries")
    return project.log().agg(F.lit(failed).alias("failed"), entries)
