"""Exact top-k against SQL and brute force."""

import math

import numpy as np
import pytest
from compare import connect, mismatch
from pyspark.sql import functions as F

from formlake.llm.queries import ORACLES, QUERIES
from formlake.llm.vector_topk import Approximation, top_k

FOLDER = "/root/testdata/sf0.001"


def test_top_k_equals_sql(spark):
    assert mismatch(QUERIES["op5_vector_topk"](spark, FOLDER), connect(FOLDER), ORACLES["op5_vector_topk"]) is None


def test_bounds_hold():
    pick = np.random.default_rng(3)
    exact = np.floor(pick.normal(size=(500, 12)) * 1024)
    asks = np.floor(pick.normal(size=(40, 12)) * 1024)
    assert (Approximation(exact).bounds(asks) >= asks @ exact.T).all()


@pytest.mark.parametrize("chunk, block", [(4096, 8192), (7, 2)])
def test_odd_vectors(spark, chunk, block):
    rows = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0, 0.25]), (4, None), (5, [1.0, None]),
        (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (8, [3.0]), (9, []), (10, [0.0, 2.0]), (20, [1e6, -1e6]),
        (None, [1.0, 0.5]), (10, [0.0, 2.0]), (30, None), (40, [5.0]),
    ]
    rows += [(100 + i, [0.001 * (i % 5), 0.7]) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = top_k(table, F.col("vec_id") % 10 == 0, k=10, chunk=chunk, block=block).collect()
    sound = [
        (i, vec_id, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, (vec_id, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    wanted = []
    for place, query_id, q in sound:
        if query_id is None or query_id % 10:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v)), vec_id is None, vec_id or 0)
            for other, vec_id, v in sound
            if other != place and len(v) == len(q)
        )
        wanted += [(query_id, n + 1, i if not gone else None, -s) for n, (s, gone, i) in enumerate(scored[:10])]
    assert sorted(got, key=str) == sorted(map(tuple, wanted), key=lambda r: str(r)) or sorted(
        map(str, map(tuple, got))
    ) == sorted(map(str, wanted))


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert top_k(none, F.col("vec_id") % 10 == 0).count() == 0
