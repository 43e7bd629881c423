"""Segmented operators against plain windows, with segments small enough to be crossed often."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonewise.operators.ordered import asof_join, carry_forward, lookback, span_segment


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    # One key holds most of the rows.
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 30)}", i, rng.choice([None, i])) for i in range(2000)]
    return spark.createDataFrame(data, "k string, t long, v long").cache()


@pytest.mark.parametrize("span,depth", [(1, 1), (7, 1), (7, 5), (100, 3), (10**6, 2)])
def test_lookback(rows, span, depth):
    columns = {
        "before": lambda w: F.lag("t", depth).over(w),
        "last": lambda w: F.collect_list("t").over(w.rowsBetween(-depth, -1)),
    }
    got = lookback(rows, ["k"], ["t"], span_segment("t", span), columns, depth)
    w = Window.partitionBy("k").orderBy("t")
    want = rows.select("*", *[make(w).alias(name) for name, make in columns.items()])
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("span", [1, 7, 100, 10**6])
def test_carry_forward(rows, span):
    got = carry_forward(rows, ["k"], ["t"], span_segment("t", span), "v", "seen")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("seen", F.last("v", ignorenulls=True).over(w))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("direction,exact", [("backward", True), ("backward", False), ("forward", True), ("forward", False)])
@pytest.mark.parametrize("span", [3, 10**6])
def test_asof_join(spark, direction, exact, span):
    rng = random.Random(2)
    left = [(rng.choice("ab"), i, rng.randint(0, 60)) for i in range(200)]
    right = [(rng.choice("ab"), i, rng.randint(0, 60)) for i in range(40)]
    got = asof_join(
        spark.createDataFrame(left, "k string, id long, t long"),
        spark.createDataFrame(right, "k string, n long, u long"),
        ["k"],
        "t",
        "u",
        "hit",
        tie="n",
        direction=direction,
        allow_exact=exact,
        span=span,
    )

    def nearest(k, t):
        if direction == "backward":
            fits = [(u, n) for kk, n, u in right if kk == k and (u < t or (exact and u == t))]
            return max(fits) if fits else None
        fits = [(u, n) for kk, n, u in right if kk == k and (u > t or (exact and u == t))]
        return min(fits) if fits else None

    want = sorted((i, nearest(k, t)) for k, i, t in left)
    assert sorted((r.id, (r.hit.u, r.hit.n) if r.hit else None) for r in got.collect()) == want


def test_a_hot_key_is_split_over_tasks(rows):
    """No (key, segment) group of the main shuffle is larger than the span."""
    sizes = rows.groupBy("k", span_segment("t", 50).alias("s")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50
