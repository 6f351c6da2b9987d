"""Means that don't depend on partitions, against exact fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from formlake.operators.exact import exact_mean
from formlake.operators.verbs import below_group_mean, group_mean

KIND = "g int, v double"


def values(seed):
    pick = random.Random(seed)
    out = [0.1] * 30 + [0.1 + 0.2, 1e300, -1e300, 5e-324, -5e-324, 2.0**1023, 0.0, -0.0, 1e-310]
    out += [math.ldexp(pick.choice([-1, 1]) * pick.random(), pick.randint(-1060, 1000)) for _ in range(300)]
    return out + [pick.uniform(-1e6, 1e6) for _ in range(300)] + [None] * 5


def plain(rows):
    by = {}
    for g, v in rows:
        by.setdefault(g, []).extend([] if v is None else [Fraction(v)])
    return {g: float(sum(v) / len(v)) if v else None for g, v in by.items()}


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_means_are_exact(spark, partitions):
    rows = [(g, v) for g in range(3) for v in values(g)] + [(7, None), (8, 0.0), (9, 2.0**53), (9, 1.0), (9, 1.0)]
    rows += [(None, 0.1), (None, 0.2)]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, KIND).repartition(partitions)
    assert {r["g"]: r["mean"] for r in group_mean(df, ["g"], "v").collect()} == plain(rows)


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_ties_with_the_mean(spark, partitions):
    """Sums of doubles would round to other means in other orders, and let equal values slip below."""
    rows = [(n, x) for n in range(1, 60) for x in [0.1] * n] + [(100 + n, x) for n in range(20) for x in (1e16, 1.0, -1e16, 1.0 / 3)]
    df = spark.createDataFrame(rows, KIND).repartition(partitions)
    kept = sorted((r["g"], r["v"]) for r in below_group_mean(df, ["g"], "v").collect())
    means = plain(rows)
    assert kept == sorted((g, v) for g, v in rows if v < means[g])
    assert not [g for g, _ in kept if g < 100]


def test_odd_values_and_types(spark):
    rows = [(1, math.nan), (1, 1.0), (2, math.inf), (2, 1.0), (3, -math.inf), (4, math.inf), (4, -math.inf), (5, None)]
    got = {r["g"]: r["m"] for r in exact_mean(spark.createDataFrame(rows, KIND), ["g"], "v", "m").collect()}
    assert math.isnan(got[1]) and got[2] == math.inf and got[3] == -math.inf and math.isnan(got[4]) and got[5] is None
    whole = spark.createDataFrame([(1, 3, 1.5), (1, 4, None)], "`a.b` int, n bigint, x float")
    assert exact_mean(whole, ["`a.b`".strip("`")], "n").first()["mean"] == 3.5
    assert exact_mean(whole.withColumnRenamed("a.b", "g"), ["g"], "x").first()["mean"] == 1.5
    tens = whole.select(F.lit(1).alias("g"), F.col("n").cast("decimal(10,2)").alias("d"))
    assert str(exact_mean(tens, ["g"], "d").first()["mean"]) == "3.500000"
    assert exact_mean(spark.createDataFrame([], KIND), ["g"], "v").count() == 0
