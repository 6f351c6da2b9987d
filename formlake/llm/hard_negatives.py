"""Hard negatives by segment summary filtering.

Each vector is stored with a summary: for segments of two components the mean and the
deviation, as shares of the vector's length. Two vectors' inner product is the sum over
segments of the product of means, give or take at most the product of deviations; longer
segments' summaries follow from those of their parts. A scan bounds scores by long segments,
refines what is left by shorter ones, and reads exact vectors last. Scores must lie in a
window, so bounds cut from both sides: for positives the window is open, for negatives it
comes from the positive's score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formlake.llm.batches import named
from formlake.llm.vector_topk import quantised
from formlake.llm.written import written

FINEST = 2  # components in a stored segment
LENGTHS = (16, 4, 2)  # of segments, in the order of refinement
CHUNK_BYTES = 32 << 20  # of exact vectors, 8 bytes a component, that meet anchors in a task
BLOCK_BYTES = 8 << 20  # of anchors there
LEAST_ROWS = 1024  # in a chunk, where more chunks would only occupy more cores
SLACK = 1e-5  # of the product of two lengths: far more than single precision loses
_CELLS = 1 << 20  # scores held at a time
_SEEDS = 4  # exact scores for each one wanted that set the first threshold


# --- summaries ---------------------------------------------------------------------------


def summarise(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of vectors, and the finest segments' means and deviations as shares of them.

    A segment's mean is multiplied by the root of its size, so that products of means need no factor.
    """
    exact = exact.astype(np.float64)
    length = np.sqrt((exact * exact).sum(axis=1))
    shares = exact / np.where(length > 0, length, 1.0)[:, None]
    starts = np.arange(0, exact.shape[1], FINEST)
    sizes = np.diff(np.append(starts, exact.shape[1]))
    means = np.add.reduceat(shares, starts, axis=1) / np.sqrt(sizes)
    squares = np.add.reduceat((shares - np.repeat(means / np.sqrt(sizes), sizes, axis=1)) ** 2, starts, axis=1)
    return length, np.concatenate([means, np.sqrt(squares)], axis=1).astype("<f4")


def coarser(summary: np.ndarray, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of segments of ``size`` components, from those of the finest."""
    means, deviations = np.split(summary, 2, axis=1)
    if size == FINEST:
        return means, deviations
    fine = np.diff(np.append(np.arange(0, width, FINEST), width))
    starts = np.arange(0, len(fine), size // FINEST)
    sizes = np.add.reduceat(fine, starts)
    means, deviations = means.astype(np.float64), deviations.astype(np.float64)
    sums = np.add.reduceat(means * np.sqrt(fine), starts, axis=1) / np.sqrt(sizes)
    squares = np.add.reduceat(means**2 + deviations**2, starts, axis=1)
    spread = np.sqrt(np.maximum(squares - sums**2, 0) + 1e-6)  # rounded up: a difference loses places
    return sums.astype("<f4"), spread.astype("<f4")


class Vectors:
    """Rows of an Arrow table in the order of their ids, null ids last."""

    def __init__(self, table: pa.Table, width: int):
        table = table.sort_by([("vec_id", "ascending"), ("row_no", "ascending")])
        self.width, self.size = width, table.num_rows
        self.ids = table.column("vec_id").to_pylist()
        self.row_no = table.column("row_no").to_numpy()
        self.label = table.column("label").to_numpy()
        self.length = table.column("length").to_numpy()
        packed = table.column("exact").to_pylist()
        if all(len(p) == 4 * width for p in packed):
            self.exact = np.frombuffer(b"".join(packed), "<i4").reshape(self.size, width)
        else:
            self.exact = np.stack([np.frombuffer(p, "<i4" if len(p) == 4 * width else "<i8") for p in packed])
        parts = 2 * -(-width // FINEST)
        summary = np.frombuffer(b"".join(table.column("summary").to_pylist()), "<f4").reshape(self.size, parts)
        self.levels = [coarser(summary, width, size) for size in LENGTHS] if width else []
        self.table = table


def products(asks: Vectors, some: slice | np.ndarray, rows: Vectors, which: np.ndarray) -> np.ndarray:
    """Exact inner products. Those too large for whole doubles are summed as longs."""
    left, right = asks.exact[some], rows.exact[which]
    if float(asks.length.max(initial=0)) * float(rows.length.max(initial=0)) < 2**52:
        return left.astype(np.float64) @ right.astype(np.float64).T
    return left.astype(np.int64) @ right.astype(np.int64).T


def _pairs(asks: Vectors, ask: np.ndarray, rows: Vectors, row: np.ndarray) -> np.ndarray:
    """Exact inner products of single pairs."""
    return np.einsum("ij,ij->i", asks.exact[ask].astype(np.int64), rows.exact[row].astype(np.int64))


LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass
class Windows:
    """For each ask, ranges of scores (as longs) that are wanted; an empty one holds nothing."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def open(cls, asks: int) -> Windows:
        return cls(np.full((asks, 1), LOWEST), np.full((asks, 1), HIGHEST))


def search(
    asks: Vectors, rows: Vectors, allowed: Callable[[slice], np.ndarray], windows: Windows, k: int
) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], list[int]]:
    """The k highest scores of each ask in each of its windows, ties by the order of rows.

    Returns (ask, window, row, score) arrays, and how many pairs were left after each level.
    ``allowed`` gives, for a slice of asks, which rows count at all.
    """
    found, left = [], [0] * (len(LENGTHS) + 2)
    step = max(1, _CELLS // max(1, rows.size))
    for first in range(0, asks.size, step):
        some = slice(first, min(first + step, asks.size))
        low, high = windows.low[some], windows.high[some]
        length = asks.length[some][:, None]
        which, alive = np.arange(rows.size), allowed(some)
        alive &= (low <= high).any(axis=1)[:, None]
        left[0] += int(alive.sum())
        least = np.where(low <= high, low, HIGHEST).min(axis=1)
        most = np.where(low <= high, high, LOWEST).max(axis=1)
        for level, (ask_means, ask_spreads) in enumerate(asks.levels):
            keep = alive.any(axis=0)
            if not keep.all():
                which, alive = which[keep], alive[:, keep]
            if not len(which):
                break
            means, spreads = rows.levels[level][0][which], rows.levels[level][1][which]
            scale = length * rows.length[which]
            middle = (ask_means[some] @ means.T).astype(np.float64)
            reach = (ask_spreads[some] @ spreads.T).astype(np.float64) + SLACK
            if level == len(asks.levels) - 1:  # thresholds from a few exact scores
                low = _raised(asks, first, rows, which, alive, middle * scale, low, high, k)
                least = np.where(low <= high, low, HIGHEST).min(axis=1)
            alive &= ((middle + reach) * scale >= least[:, None]) & ((middle - reach) * scale <= most[:, None])
            left[level + 1] += int(alive.sum())
        keep = alive.any(axis=0)
        which, alive = which[keep], alive[:, keep]
        if not len(which):
            continue
        left[-1] += alive.size
        scores = products(asks, some, rows, which)
        for window in range(low.shape[1]):
            inside = alive & (scores >= low[:, window : window + 1]) & (scores <= high[:, window : window + 1])
            ask, at = _highest(scores, inside, k)
            if len(ask):
                found.append((ask + first, np.full(len(ask), window), which[at], scores[ask, at].astype(np.int64)))
    return found, left


def _raised(
    asks: Vectors, first: int, rows: Vectors, which: np.ndarray, alive: np.ndarray,
    likely: np.ndarray, low: np.ndarray, high: np.ndarray, k: int,
) -> np.ndarray:
    """Windows' lower ends, raised to the k-th of the exact scores of the likeliest rows."""
    low = low.copy()
    take = min(len(which), _SEEDS * k)
    for window in range(low.shape[1]):
        guess = np.where(alive & (likely <= high[:, window : window + 1]), likely, -np.inf)
        at = np.argpartition(-guess, take - 1, axis=1)[:, :take]
        ask = np.repeat(np.arange(len(at)), take)
        scores = _pairs(asks, ask + first, rows, which[at.reshape(-1)]).reshape(at.shape)
        inside = np.take_along_axis(alive, at, axis=1) & (scores >= low[:, window : window + 1])
        inside &= scores <= high[:, window : window + 1]
        scores = np.sort(np.where(inside, scores, LOWEST), axis=1)[:, ::-1]
        if take >= k:
            low[:, window] = np.maximum(low[:, window], scores[:, k - 1])
    return low


def _highest(scores: np.ndarray, inside: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k highest scores inside each row, ties by place."""
    values = np.where(inside, scores.astype(np.float64), -np.inf)
    kth = np.full(len(values), -np.inf)
    if values.shape[1] > k:
        kth = -np.partition(-values, k - 1, axis=1)[:, k - 1]
    row, at = np.nonzero(inside & (values >= kth[:, None]))
    order = np.lexsort((at, -scores[row, at], row))
    row, at = row[order], at[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], at[rank < k]


# --- Spark -------------------------------------------------------------------------------

_STORED = "row_no bigint, vec_id bigint, label bigint, width int, length double, summary binary, exact binary"


def _store(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with their summaries; those of one width in a batch together."""
    for batch in batches:
        widths = batch.column("width").to_numpy()
        for width in np.unique(widths):
            part = batch.filter(pa.array(widths == width))
            flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
            exact = flat.astype(np.int64).reshape(part.num_rows, int(width))
            length, summary = summarise(exact) if width else (np.zeros(len(exact)), np.zeros((len(exact), 0), "<f4"))
            short = np.abs(exact).max(axis=1, initial=0) < 2**31
            packed = [row.astype("<i4" if s else "<i8").tobytes() for row, s in zip(exact, short)]
            columns = [part.column(c) for c in ("row_no", "vec_id", "label", "width")]
            columns += [pa.array(length), pa.array([s.tobytes() for s in summary], pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _STORED.split(", ")])


def _pieces(rows: Column, width: Column, limit: int, cores: int) -> Column:
    """Into how many parts rows go: by their bytes, and no fewer than keep the cores busy."""
    whole = F.ceil(rows * F.greatest(width, F.lit(1)) * 8 / limit)
    return F.greatest(whole, F.least(F.lit(cores), F.ceil(rows / LEAST_ROWS)), F.lit(1)).cast("int")


def _met(
    stored: DataFrame, asked: DataFrame, group: list[str], found: Callable, schema: str, chunk_bytes: int, block_bytes: int
) -> DataFrame:
    """Blocks of asked rows meet chunks of stored rows of the same ``group``.

    The asked rows are a stated query set, searched against all rows in blocks.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    counts = stored.groupBy(*group).agg(F.count("*").alias("rows"))
    asking = asked.groupBy(*group).agg(F.count("*").alias("asking"))
    parts = counts.join(asking, group).select(
        *group,
        _pieces(F.col("rows"), F.col("width"), chunk_bytes, cores).alias("chunks"),
        F.ceil(F.col("asking") * F.greatest("width", F.lit(1)) * 8 / block_bytes).cast("int").alias("blocks"),
    )
    parts = written(parts, "parts")

    def dealt(rows: DataFrame, own: str, others: str, own_key: str, other_key: str) -> DataFrame:
        rows = rows.join(parts, group)
        rows = rows.withColumn(own_key, F.pmod(F.xxhash64("row_no"), F.col(own)).cast("int"))
        return rows.withColumn(other_key, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("chunks", "blocks")

    keys = [*group, "chunk", "block"]
    chunks = dealt(stored, "chunks", "blocks", "chunk", "block").groupBy(*keys)
    blocks = dealt(asked, "blocks", "chunks", "block", "chunk").groupBy(*keys)
    return chunks.cogroup(blocks).applyInArrow(found, schema)


_FOUND = "anchor_no bigint, slot int, row_no bigint, vec_id bigint, score bigint"


_FOUND_ARROW = pa.schema(
    [("anchor_no", pa.int64()), ("slot", pa.int32()), ("row_no", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)


def _table(asks: Vectors, rows: Vectors, parts: list) -> pa.Table:
    ask, window, row, score = (np.concatenate(c) for c in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
    columns = [
        pa.array(asks.row_no[ask], pa.int64()),
        pa.array(window, pa.int32()),
        pa.array(rows.row_no[row], pa.int64()),
        pa.array([rows.ids[i] for i in row.tolist()], pa.int64()),
        pa.array(score, pa.int64()),
    ]
    return pa.table(columns, names=["anchor_no", "slot", "row_no", "vec_id", "score"])


def _positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def found(chunk: pa.Table, block: pa.Table) -> pa.Table:
        if not chunk.num_rows or not block.num_rows:
            return _FOUND_ARROW.empty_table()
        width = chunk.column("width")[0].as_py()
        asks, rows = Vectors(block, width), Vectors(chunk, width)
        others = lambda some: asks.row_no[some][:, None] != rows.row_no[None, :]
        return _table(asks, rows, search(asks, rows, others, Windows.open(asks.size), k)[0])

    return found


def _negatives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def found(chunk: pa.Table, block: pa.Table) -> pa.Table:
        if not chunk.num_rows or not block.num_rows:
            return _FOUND_ARROW.empty_table()
        width = chunk.column("width")[0].as_py()
        asks, rows = Vectors(block, width), Vectors(chunk, width)
        lows, highs = (asks.table.column(c).to_pylist() for c in ("lows", "highs"))
        slots = max(map(len, lows))
        low, high = np.full((asks.size, slots), HIGHEST), np.full((asks.size, slots), LOWEST)
        for i, (a, b) in enumerate(zip(lows, highs)):
            low[i, : len(a)], high[i, : len(b)] = a, b
        others = lambda some: asks.label[some][:, None] != rows.label[None, :]
        return _table(asks, rows, search(asks, rows, others, Windows(low, high), k)[0])

    return found


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of all chunks, each of which has given its own k best."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row_no")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor_of: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    chunk_bytes: int = CHUNK_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which ``anchor_of`` (over column vec_id) holds; null ids are
    none. An anchor's positives are its best other rows of the same label; a negative is a row of
    another label whose score is between the two shares of the positive's. Components become
    floor(scale * x). Rows with a null label, a null vector, or one that holds nulls, NaN or
    infinities take no part; only vectors of the same number of components meet. Ties go to
    the smaller id, null ids last, then to the row read first. Repeated rows count each. An
    empty table gives no rows. Scores must fit a long.
    """
    rows = vectors.select(
        named(id_column).cast("bigint").alias("vec_id"),
        named(label_column).cast("bigint").alias("label"),
        quantised(named(vector_column), scale).alias("v"),
    ).where("v is not null and label is not null")
    rows = rows.withColumn("row_no", F.monotonically_increasing_id()).withColumn("width", F.size("v"))
    stored = written(rows.mapInArrow(_store, _STORED), "summaries")
    anchors = written(stored.where(F.coalesce(anchor_of, F.lit(False)) & F.col("vec_id").isNotNull()), "anchors")
    limits = (chunk_bytes, block_bytes)

    near = _met(stored, anchors, ["width", "label"], _positives(positives), _FOUND, *limits)
    best = _ranked(near, ["anchor_no"], positives).select(
        "anchor_no",
        F.struct(
            F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
            F.expr(f"cast(ceil(score * {least_percent}BD / 100) as bigint)").alias("low"),
            F.expr(f"cast(floor(score * {most_percent}BD / 100) as bigint)").alias("high"),
        ).alias("positive"),
    )
    best = best.groupBy("anchor_no").agg(F.sort_array(F.collect_list("positive")).alias("found"))  # at most ``positives``
    best = written(best, "positives")
    asked = anchors.join(best, anchors["row_no"] == best["anchor_no"]).drop("anchor_no")
    asked = asked.withColumn("lows", F.col("found.low")).withColumn("highs", F.col("found.high"))
    asked = written(asked.where("exists(found, p -> p.low <= p.high)"), "windows")

    far = _met(stored, asked.drop("found"), ["width"], _negatives(negatives), _FOUND, *limits)
    ranked = _ranked(far, ["anchor_no", "slot"], negatives)
    named_by = asked.select(F.col("row_no").alias("anchor_no"), F.col("vec_id").alias("anchor_id"), "found")
    met = ranked.join(named_by, "anchor_no").withColumn("positive", F.expr("found[slot]"))
    return met.select(
        "anchor_id",
        F.col("positive.positive_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("positive.positive_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
