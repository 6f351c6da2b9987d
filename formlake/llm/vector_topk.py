"""Exact top-k inner products with vector-approximation files.

Vectors meet queries in blocks: a chunk of vectors and a block of queries in each task. A
chunk is kept twice, as cells of a few bits per component and exactly. The scan of the
cells bounds every score from above (the distance from below); exact vectors are then
read in the order of that bound until the k-th score is above all bounds that remain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.llm.batches import named
from formlake.llm.written import written

CHUNK = 1 << 12  # vectors in a task
BLOCK = 1 << 13  # queries in a task
CELLS = 16  # for each component
_FIRST = 64  # exact vectors read before the bounds are looked at again
_FOUND = "query_no bigint, query_id bigint, vec_id bigint, vec_no bigint, score bigint"


def quantised(vector: Column, scale: int = 1024) -> Column:
    """Components as floor(scale * x); null for a vector that holds anything but finite numbers."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


class Approximation:
    """Cells of a chunk: for each component, values between quantiles share a cell."""

    def __init__(self, exact: np.ndarray):
        rows, width = exact.shape
        self.cells = np.empty((rows, width), np.uint8)
        self.low = np.empty((width, CELLS))
        self.high = np.empty((width, CELLS))
        for c in range(width):
            column = exact[:, c]
            edges = np.quantile(column, np.arange(1, CELLS) / CELLS, method="lower")
            cell = np.searchsorted(edges, column, side="left").astype(np.uint8)
            self.cells[:, c] = cell
            low, high = np.full(CELLS, np.inf), np.full(CELLS, -np.inf)
            np.minimum.at(low, cell, column)
            np.maximum.at(high, cell, column)
            self.low[c], self.high[c] = low, high

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each query (rows) with each vector (columns)."""
        at = np.arange(self.cells.shape[1])
        low, high = self.low[at, self.cells], self.high[at, self.cells]
        return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def _best(scores: np.ndarray, places: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by ``order``."""
    return places[np.lexsort((order[places], -scores))[:k]]


def _search(bounds: np.ndarray, query: np.ndarray, exact: np.ndarray, own: int, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best vectors for one query; ``own`` is the query's place or -1."""
    if own >= 0:
        bounds[own] = -np.inf
    take = min(max(_FIRST, k), len(bounds))
    read = np.argpartition(-bounds, take - 1)[:take]
    while True:
        read = read[bounds[read] > -np.inf]
        best = _best(exact[read] @ query, read, order, k)
        if len(best) < k:
            needed = np.nonzero(bounds > -np.inf)[0]
        else:  # a tie may still win by its id
            needed = np.nonzero(bounds >= exact[best[-1]] @ query)[0]
        if len(needed) <= len(read):
            return best
        read = needed


def top_k(
    vectors: DataFrame,
    query_of: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query.

    Queries are the rows of ``vectors`` for which ``query_of`` (over doc column vec_id)
    holds; candidates are all rows of the same number of components but the query's own
    row. Ties go to the smaller id, null ids last, then to the row read first. Vectors
    that are null or hold nulls, NaN or infinities take no part. Repeated rows count
    each. An empty table gives no rows. Scores must fit a long.
    """
    rows = vectors.select(named(id_column).cast("bigint").alias("vec_id"), quantised(named(vector_column), scale).alias("v"))
    rows = rows.where("v is not null").withColumn("vec_no", F.monotonically_increasing_id())
    rows = written(rows.withColumn("width", F.size("v")), "vectors")
    asked = written(rows.where(query_of), "queries")
    chunks, blocks = -(-rows.count() // chunk) or 1, -(-asked.count() // block) or 1
    # Every chunk meets every block: the queries are a stated set, searched against all rows.
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("vec_no"), F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    asking = asked.withColumn("block", F.pmod(F.xxhash64("vec_no"), F.lit(blocks)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )

    def matrix(table: pa.Table, width: int) -> np.ndarray:
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.astype(np.int64).reshape(table.num_rows, width)

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if candidates.num_rows and queries.num_rows:
            width = candidates.column("width")[0].as_py()
            exact, asks = matrix(candidates, width), matrix(queries, width)
            ids, numbers = candidates.column("vec_id").to_pylist(), candidates.column("vec_no").to_pylist()
            by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, numbers[i]))
            order = np.empty(len(ids), np.int64)
            order[by_id] = np.arange(len(ids))
            place = {number: i for i, number in enumerate(numbers)}
            top = max(1, float(np.abs(exact).max(initial=0))) * max(1, float(np.abs(asks).max(initial=0)))
            cells = Approximation(exact) if top * max(1, width) < 2**52 else None
            if cells:  # whole numbers of this size are exact as doubles
                exact = exact.astype(np.float64)
            query_ids, query_nos = queries.column("vec_id").to_pylist(), queries.column("vec_no").to_pylist()
            step = max(1, (1 << 22) // len(ids))
            for first in range(0, len(asks), step):
                some = asks[first : first + step]
                bounds = cells.bounds(some) if cells else np.full((len(some), len(ids)), np.inf)
                for i, query in enumerate(some):
                    number = query_nos[first + i]
                    best = _search(bounds[i], query, exact, place.get(number, -1), order, k)
                    scores = (exact[best] @ query).astype(np.int64).tolist()
                    out += [(number, query_ids[first + i], ids[b], numbers[b], s) for b, s in zip(best.tolist(), scores)]
        names = ["query_no", "query_id", "vec_id", "vec_no", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], names=names)

    keys = ("width", "chunk", "block")
    found = dealt.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(search, _FOUND)
    best = Window.partitionBy("query_no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_no")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")
    )
