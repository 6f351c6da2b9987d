"""Hard negatives against SQL and brute force; bounds of segment summaries."""

import math

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, mismatch
from pyspark.sql import functions as F

from formlake.llm import hard_negatives
from formlake.llm.hard_negatives import LENGTHS, Vectors, Windows, coarser, mine_hard_negatives, search, summarise
from formlake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_equals_sql(spark, size):
    folder = f"/root/testdata/{size}"
    assert mismatch(QUERIES["op13_hard_negatives"](spark, folder), connect(folder), ORACLES["op13_hard_negatives"]) is None


@pytest.mark.parametrize("width, size", [(64, 1.0), (7, 1e-3), (1, 1e6), (33, 1e12)])
def test_bounds_hold(width, size):
    pick = np.random.default_rng(width)
    exact = np.floor(pick.normal(size=(300, width)) * size * 256) + pick.integers(-3, 3, (300, 1)) * size
    exact[5] = 0
    length, summary = summarise(exact)
    scores = (exact @ exact.T) / np.maximum(np.outer(length, length), 1e-300)
    for segment in LENGTHS:
        means, spreads = (x.astype(float) for x in coarser(summary, width, segment))
        middle, reach = means @ means.T, spreads @ spreads.T + hard_negatives.SLACK
        assert (middle + reach >= scores).all() and (middle - reach <= scores).all()


def table(exact, labels):
    length, summary = summarise(exact)
    packed = [row.astype("<i4").tobytes() for row in exact]
    return pa.table(
        {
            "row_no": np.arange(len(exact)), "vec_id": np.arange(len(exact)), "label": labels, "length": length,
            "summary": pa.array([s.tobytes() for s in summary], pa.binary()), "exact": pa.array(packed, pa.binary()),
        }
    )


def test_summaries_spare_exact_scores_where_vectors_are_smooth():
    """Neighbouring components that resemble each other: few pairs are left after each level."""
    pick = np.random.default_rng(2)
    centres = np.repeat(pick.normal(size=(40, 4)), 16, axis=1)
    exact = np.floor(256 * (centres[pick.integers(0, 40, 3000)] + 0.05 * pick.normal(size=(3000, 64))))
    rows, asks = Vectors(table(exact, np.zeros(3000, int)), 64), Vectors(table(exact[:50], np.zeros(50, int)), 64)
    others = lambda some: asks.row_no[some][:, None] != rows.row_no[None, :]
    found, left = search(asks, rows, others, Windows.open(50), 5)
    assert left[-1] < 0.1 * left[0] and left[3] <= left[2] <= left[1] <= left[0]
    ask, _, row, score = (np.concatenate(c) for c in zip(*found))
    for i in range(50):
        scores = exact @ exact[i]
        scores[i] = -np.inf
        order = np.lexsort((np.arange(3000), -scores))[:5]
        assert row[ask == i].tolist() == order.tolist() and (score[ask == i] == scores[order]).all()


ROWS = [
    (0, [1.0, 0.5, 0.25], 1), (50, [1.0, 0.5, 0.25], 1), (1, [1.0, 0.5, 0.25], 1), (2, [0.5, 0.5, 0.25], 2),
    (3, None, 1), (4, [1.0, None, 1.0], 2), (5, [math.nan, 1.0, 1.0], 2), (6, [math.inf, 1.0, 0.0], 1),
    (7, [3.0], 1), (100, [], 1), (8, [], 1), (9, [], 2), (150, [-1.0, 0.0, 0.0], 3), (10, [1.0, 0.0, 0.0], 3),
    (None, [1.0, 0.5, 0.25], 1), (None, [0.7, 0.5, 0.25], 2), (50, [1.0, 0.5, 0.25], 1), (200, [1.0, 0.5, 0.2], None),
    (11, [0.9, 0.4, 0.25], 4), (12, [0.6, 0.4, 0.25], 4), (12, [0.6, 0.4, 0.25], 4), (250, [3e6, 2e6, 1e6], 5),
    (13, [3e6, 2e6, 1e6], 5), (14, [2e6, 2e6, 1e6], 6), (300, [0.0, 0.0, 0.0], 7), (15, [1.0, 0.0, 0.0], 7),
]


def brute(rows):
    sound = [
        (n, i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for n, (i, v, label) in enumerate(rows)
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    rank = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = []
    for n, anchor, label, q in sound:
        if anchor is None or anchor % 50:
            continue
        met = [(sum(a * b for a, b in zip(q, v)), i, m, other) for m, i, other, v in sound if m != n and len(v) == len(q)]
        for p in sorted((s for s in met if s[3] == label), key=rank)[:5]:
            inside = [s for s in met if s[3] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]]
            out += [(anchor, p[1], r + 1, s[1], p[0], s[0]) for r, s in enumerate(sorted(inside, key=rank)[:3])]
    return sorted(out, key=str)


@pytest.mark.parametrize("bytes_", [1 << 25, 64])
def test_odd_vectors(spark, bytes_):
    pick = np.random.default_rng(3)
    rows = ROWS + [(400 + i, [float(x) for x in pick.normal(size=3).round(1)], int(pick.integers(1, 4))) for i in range(80)]
    table_ = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, width int, v string")
    got = mine_hard_negatives(table_, F.col("vec_id") % 50 == 0, chunk_bytes=bytes_, block_bytes=bytes_)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert mine_hard_negatives(none, F.col("vec_id") % 50 == 0).count() == 0
