"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Documents are written once into a table bucketed by the partition they were read in,
   so that a partition's rows can be found again without a shuffle.
2. Each partition sends its distinct fingerprints, cut to as many bits as the number of
   documents calls for, sorted and Golomb coded, to the owners of their ranges.
3. Owners answer with a bitmap: which of these fingerprints came from several partitions.
4. Partitions mark their suspects. Only suspects are shuffled, grouped by their bytes;
   all others are unique and stay where they are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.llm import golomb
from formlake.llm.batches import named
from formlake.llm.pinned import WORDS, bitmap, flagged, pin
from formlake.llm.written import written

WHITE_SPACE = " \t\n\x0b\x0c\r"
_SPARE_BITS = 10  # so one document in 2 ** 10 is a suspect by chance
_OWNED = 1 << 21  # fingerprints for each owner, about

_MESSAGE = "owner int, part int, n int, bits int, unary binary, low binary"
_REPLY = "part int, owner int, flags binary"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _staged(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """All columns as ``document``, with digests and the row's partition and place in it."""
    text = normalised(F.col("document")[text_column])
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("document"))
    rows = rows.select(
        "document",
        F.col("document")[id_column].cast("bigint").alias("doc_id"),
        F.length(F.coalesce(F.col("document")[text_column], F.lit(""))).alias("n_chars"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha256"),
        F.xxhash64(text).alias("fingerprint"),
    )
    return pin(rows, "exact-dedup")


def _own(fingerprints: np.ndarray, bits: int, owner_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cut fingerprints in order, each row's place among them, counts, and owners."""
    cut = fingerprints.view(np.uint64) >> np.uint64(64 - bits)
    values, inverse, counts = np.unique(cut, return_inverse=True, return_counts=True)
    return values, inverse, counts, (values >> np.uint64(bits - owner_bits)).astype(np.int64)


def suspects_by_part(thin: DataFrame, rows: int) -> DataFrame:
    """part and words: a bitmap over the rows of each partition that holds any suspect."""
    spark = thin.sparkSession
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owner_bits = max(1, math.ceil(math.log2(max(2, parallel, rows / _OWNED))))
    bits = min(62, max(owner_bits + 1, math.ceil(math.log2(max(2, rows))) + _SPARE_BITS))

    def send(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        values, _, _, owners = _own(table.column("fingerprint").to_numpy(), bits, owner_bits)
        cuts = np.searchsorted(owners, np.arange((1 << owner_bits) + 1))
        base = np.uint64(bits - owner_bits)
        out = []
        for owner in np.unique(owners).tolist():
            own = values[cuts[owner] : cuts[owner + 1]] - (np.uint64(owner) << base)
            out.append((owner, part, len(own), *golomb.encode(own)))
        columns = list(zip(*out))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        names = ["owner", "part", "n", "bits", "unary", "low"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def answer(table: pa.Table) -> pa.Table:
        owner = table.column("owner")[0].as_py()
        parts = table.column("part").to_pylist()
        got = [
            golomb.decode(*m)
            for m in zip(*(table.column(c).to_pylist() for c in ("n", "bits", "unary", "low")))
        ]
        every = np.concatenate(got)
        order = np.argsort(every, kind="stable")
        same = every[order][1:] == every[order][:-1]
        shared = np.zeros(len(every), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        ends = np.cumsum([len(g) for g in got])[:-1]
        flags = [np.packbits(f).tobytes() if f.any() else None for f in np.split(shared, ends)]
        kept = [(p, owner, f) for p, f in zip(parts, flags) if f is not None]
        columns = list(zip(*kept)) or [[], [], []]
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary()))],
            names=["part", "owner", "flags"],
        )

    def mark(thin_rows: pa.Table, replies: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], pa.int32()), pa.array([], pa.list_(pa.int64()))], names=["part", "words"])
        if not thin_rows.num_rows:
            return empty
        part = thin_rows.column("part")[0].as_py()
        _, inverse, counts, owners = _own(thin_rows.column("fingerprint").to_numpy(), bits, owner_bits)
        suspect = counts > 1
        cuts = np.searchsorted(owners, np.arange((1 << owner_bits) + 1))
        for owner, flags in zip(replies.column("owner").to_pylist(), replies.column("flags").to_pylist()):
            own = slice(cuts[owner], cuts[owner + 1])
            sent = int(cuts[owner + 1] - cuts[owner])
            suspect[own] |= np.unpackbits(np.frombuffer(flags, np.uint8))[:sent].astype(bool)
        if not suspect.any():
            return empty
        return bitmap(part, thin_rows.column("row_no").to_numpy()[suspect[inverse]])

    fingerprints = thin.select("part", "row_no", "fingerprint")
    messages = fingerprints.groupBy("part").applyInArrow(send, _MESSAGE)
    replies = messages.groupBy("owner").applyInArrow(answer, _REPLY)
    return fingerprints.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(mark, WORDS)


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every input row as ``document``, with its group.

    keep_id, group_size, kept, text_sha256: texts are equal when they are after white space
    is deleted; null counts as empty. Of equal texts the one with the most code points in
    the original text stays, then the smallest id (null last), then the first row read, so
    of repeated rows exactly one stays. An empty table gives no rows. Columns of any name
    are kept inside ``document``.
    """
    staged = _staged(docs, id_column, text_column)
    words = written(suspects_by_part(staged, staged.count()), "suspects-bitmap")
    marked = flagged(staged, words, "suspect")
    columns = ["document", "doc_id", "n_chars", "sha256", "row_no"]
    suspects = written(marked.where("suspect").select(*columns), "suspects")
    text = normalised(F.col("document")[text_column])
    best = F.struct(
        (-F.col("n_chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "row_no"
    )
    groups = suspects.groupBy("sha256", text.alias("bytes")).agg(
        F.count("*").alias("group_size"), F.min(best).alias("best")
    )
    groups = written(groups, "verified-groups").withColumnRenamed("sha256", "group_sha256")
    # A hot group is split over tasks by the adaptive skew join: the groups' side has one row for it.
    verified = suspects.join(
        groups, (F.col("sha256") == F.col("group_sha256")) & (text == F.col("bytes"))
    ).select(
        "document", "doc_id", F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"), "sha256",
    )
    unique = marked.where("not suspect").select(
        "document", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "sha256",
    )
    return unique.unionByName(verified).select(
        "document", "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; odd rows as in ``exact_duplicates``."""
    kept = exact_duplicates(docs, id_column, text_column).where("kept")
    return kept.select(*[F.col("document")[c].alias(c) for c in docs.columns])
