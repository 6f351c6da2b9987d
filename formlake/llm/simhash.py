"""SimHash near-duplicates: fingerprints partitioned by vantage-point trees.

Distinct fingerprints are routed through a tree of vantage points, built from a bounded
sample, to a home shard. Each also visits the shards that the triangle inequality can't
rule out for its radius. Shards search on with vantage points of their own members and
return a spanning forest of the links they find, never all pairs of a dense group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import named, text_slices
from formlake.llm.components import connected
from formlake.llm.pinned import bitmaps, flagged, pin
from formlake.llm.workers import enter
from formlake.llm.written import written

SHARDS = 64  # at least; more where a shard would get more than SHARD_MEMBERS
SHARD_MEMBERS = 1 << 16
SAMPLE = 8192  # fingerprints from which the tree is built
_SMALL = 256  # members that are compared one by one
_CELLS = 1 << 21  # distances held at a time


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, as a signed integer; 0 without words."""
    found = text.lower().split()  # both know ASCII only, and split at the white space asked for
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(ones * 2 > len(bits)).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, text_column: str = "text", words: int = 4) -> DataFrame:
    """All columns as ``document``, and ``fingerprint``; null text counts as empty."""

    def prints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enter("simhash")
        for array in texts:
            table = pa.RecordBatch.from_arrays([array.cast(pa.string())], names=["text"])
            out = [fingerprint(t.encode("utf-8"), words) for _, part in text_slices([table]) for t in part]
            yield pa.array(out, pa.int64())

    prints.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    simhash = F.arrow_udf(prints, "bigint")
    document = F.struct(*[named(c) for c in docs.columns]).alias("document")
    text = F.coalesce(named(text_column), F.lit(""))
    return docs.select(document, simhash(text).alias("fingerprint"))


def _distance(prints: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints ^ point)


@dataclass
class Node:
    """A vantage point; a subtree is a Node or the number of a shard."""

    point: np.uint64
    radius: int
    inner: Node | int
    outer: Node | int


def build_tree(sample: np.ndarray, shards: int) -> tuple[Node | int, int]:
    """A tree over a sample (uint64), and its number of shards: at most ``shards``."""
    made = 0

    def grow(members: np.ndarray, share: int) -> Node | int:
        nonlocal made
        if share > 1 and len(members) > 1:
            point = members[len(members) // 2]
            distances = _distance(members, point)
            radius = int(np.median(distances))
            if not (distances > radius).any():
                radius = int(distances.max()) - 1
            inside = distances <= radius
            if inside.any() and not inside.all():
                return Node(point, radius, grow(members[inside], share // 2), grow(members[~inside], share // 2))
        made += 1
        return made - 1

    return grow(sample, shards), made


def visits(tree: Node | int, prints: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard: places of the fingerprints that must look into it, and whether it is their home."""
    stack = [(tree, np.arange(len(prints)), np.ones(len(prints), bool))]
    while stack:
        node, at, home = stack.pop()
        if not len(at):
            continue
        if not isinstance(node, Node):
            yield node, at, home
            continue
        distances = _distance(prints[at], node.point).astype(np.int64)
        inside = distances <= node.radius
        near = distances <= node.radius + reach
        far = distances > node.radius - reach
        stack.append((node.inner, at[near], home[near] & inside[near]))
        stack.append((node.outer, at[far], home[far] & ~inside[far]))


class Forest:
    """Links reduced to one label for each connected set, as they are found."""

    def __init__(self, size: int):
        self.labels = np.arange(size)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.labels[left], self.labels[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.labels, np.maximum(a, b), np.minimum(a, b))
            while (jumped := self.labels[self.labels]).tobytes() != self.labels.tobytes():
                self.labels = jumped


def search(prints: np.ndarray, members: np.ndarray, askers: np.ndarray, reach: int, forest: Forest) -> None:
    """Link each member to the askers within ``reach``; both are places in ``prints``."""
    stack = [(members, askers)]
    while stack:
        members, askers = stack.pop()
        if not len(members) or not len(askers):
            continue
        if len(members) > _SMALL:
            point = prints[members[len(members) // 2]]
            distances = _distance(prints[members], point).astype(np.int64)
            radius = int(np.median(distances))
            inside = distances <= radius
            if 8 * min(inside.sum(), (~inside).sum()) > len(members):
                asked = _distance(prints[askers], point).astype(np.int64)
                stack.append((members[inside], askers[asked <= radius + reach]))
                stack.append((members[~inside], askers[asked > radius - reach]))
                continue
        step = max(1, _CELLS // len(members))
        for first in range(0, len(askers), step):
            some = askers[first : first + step]
            near = np.bitwise_count(prints[some][:, None] ^ prints[members][None, :]) <= reach
            rows, columns = np.nonzero(near)
            left, right = some[rows], members[columns]
            other = left != right
            if other.any():
                forest.link(left[other], right[other])


def links(distinct: DataFrame, reach: int = 4) -> DataFrame:
    """Links u > v between distinct fingerprints, as spanning forests of the shards' links."""
    count = distinct.count()
    shards = max(SHARDS, 1 << max(0, (count // SHARD_MEMBERS)).bit_length())
    every = max(1, count // (2 * SAMPLE))
    picked = distinct.where(F.pmod(F.xxhash64("fingerprint"), F.lit(every)) == 0).limit(4 * SAMPLE).collect()
    sample = np.array(sorted(r["fingerprint"] for r in picked), np.int64).view(np.uint64)
    np.random.default_rng(7).shuffle(sample)
    tree, _ = build_tree(sample[: max(SAMPLE, 16 * shards)], shards)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy()
            for shard, at, home in visits(tree, signed.view(np.uint64), reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard, np.int32)), pa.array(signed[at]), pa.array(home)],
                    names=["shard", "fingerprint", "home"],
                )

    def find(table: pa.Table) -> pa.Table:
        signed = table.column("fingerprint").to_numpy()
        home = table.column("home").to_numpy()
        order = np.argsort(signed, kind="stable")
        signed, home = signed[order], home[order]
        forest = Forest(len(signed))
        if home.any():
            search(signed.view(np.uint64), np.nonzero(home)[0], np.arange(len(signed)), reach, forest)
        linked = np.nonzero(forest.labels != np.arange(len(signed)))[0]
        return pa.table({"u": pa.array(signed[linked]), "v": pa.array(signed[forest.labels[linked]])})

    routed = distinct.select("fingerprint").mapInArrow(route, "shard int, fingerprint bigint, home boolean")
    return routed.groupBy("shard").applyInArrow(find, "u bigint, v bigint").distinct()


def near_duplicate_groups(prints: DataFrame, reach: int = 4) -> DataFrame:
    """Each distinct fingerprint of ``prints`` (doc_id, fingerprint, row_no) and its component.

    component_id is the smallest id in the component, null only where no row has an id;
    keeper is the number of that row, the first one of repeated ids; rows counts them all.
    """
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")
    distinct = prints.groupBy("fingerprint").agg(F.min(best).alias("best"), F.count("*").alias("rows"))
    distinct = written(distinct, "fingerprints")
    roots = connected(links(distinct, reach))
    members = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "best", "rows", F.coalesce("root", "fingerprint").alias("root")
    )
    members = written(members, "component-members")
    whole = members.groupBy("root").agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))
    whole = written(whole, "whole-components")
    return written(
        members.select("fingerprint", "root").join(whole, "root").select(
            "fingerprint", F.col("best.doc_id").alias("component_id"), F.col("best.row_no").alias("keeper"), "rows"
        ),
        "components",
    )


def simhash_components(
    docs: DataFrame, words: int = 4, reach: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Null and empty texts have fingerprint zero and link like any other; a null id takes
    part in components but never names one; repeated rows give repeated rows; an empty
    table gives no rows.
    """
    prints = with_fingerprints(docs.select(named(id_column), named(text_column)), text_column, words)
    prints = prints.select(F.col("document")[id_column].cast("bigint").alias("doc_id"), "fingerprint")
    prints = written(prints.withColumn("row_no", F.monotonically_increasing_id()), "simhash")
    return prints.join(near_duplicate_groups(prints, reach), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, words: int = 4, reach: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component: that of the smallest id, the first read of repeated ones.

    Odd rows are linked as ``simhash_components`` says; columns of any name pass through.
    Documents are not shuffled: those to drop are found by their fingerprints, and the
    decision comes back as a bitmap.
    """
    pinned = pin(with_fingerprints(docs, text_column, words), "simhash-documents")
    doc_id = F.col("document")[id_column].cast("bigint").alias("doc_id")
    prints = pinned.select(doc_id, "fingerprint", "row_no", "part")
    several = near_duplicate_groups(prints, reach).where("rows > 1")
    dropped = prints.join(several, "fingerprint").where("row_no != keeper")
    words_of = written(bitmaps(dropped), "dropped-rows")
    kept = flagged(pinned, words_of, "dropped").where("not dropped")
    return kept.select(*[F.col("document")[c].alias(c) for c in docs.columns])
