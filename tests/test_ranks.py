"""Exact medians by rank, and bags compared by digests."""

import random

import pytest
from pyspark.sql import functions as F

from snapfold.operators import quality, ranks


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    kinds = {"even": lambda: rng.random(), "ties": lambda: float(rng.choice([1, 1, 1, 2, 50])), "exp": lambda: 10.0 ** rng.uniform(-300, 300), "one": lambda: 7.0, "far": lambda: rng.choice([-1e308, 1e308, 0.0, 5e-324]), "odd": lambda: rng.choice([float("nan"), float("inf"), -float("inf"), rng.random()]), "ints": lambda: float(rng.randrange(10**6))}
    out = [(k, f(), 1) for k, f in kinds.items() for _ in range(rng.choice([600, 601]))]
    out += [("few", 1.0, 1), ("few", 4.0, 1), ("none", None, 1), (None, 3.0, 1), ("even", None, 1)]
    return spark.createDataFrame(out, "k string, v double, low long").repartition(4)


@pytest.mark.parametrize("few", [60, 10_000])
def test_medians(rows, few):
    expected = {r["k"]: r["m"] for r in rows.where("v is not null and k is not null").groupBy("k").agg(F.median("v").alias("m")).collect()}
    got = {r["k"]: r["m"] for r in ranks.medians(rows, ["k"], "v", "m", few).collect()}
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in expected.items()}


def test_other_ranks(rows):
    numbers = sorted(r["v"] for r in rows.where("k = 'ints'").collect())
    r = ranks.at_ranks(rows.where("k = 'ints'"), ["k"], "v", 0.9, 20).first()
    place = (len(numbers) - 1) * 0.9
    assert (r["low"], r["high"]) == (numbers[int(place)], numbers[-int(-place // 1)])


def test_bags(spark):
    rng = random.Random(7)
    a = [(rng.randrange(50), rng.choice([None, "x", "y"])) for _ in range(3000)]
    b = a[:]
    rng.shuffle(b)
    left, same = spark.createDataFrame(a, "n long, s string"), spark.createDataFrame(b, "m long, t string").repartition(3)
    assert quality.bag_difference(left, same).count() == 0
    other = spark.createDataFrame([*b[5:], (99, None), (99, None)], "m long, t string")
    expected = sorted([(*r, "left") for r in b[:5]] + [(99, None, "right")] * 2, key=str)
    got = quality.bag_difference(left, other)
    assert got.columns == ["n", "s", "side"] and sorted(map(tuple, got.collect()), key=str) == expected
    assert quality.bag_difference(left, left.limit(0)).where("side = 'left'").count() == 3000


def test_equal_bags_shuffle_no_rows(spark):
    """Once the digests are equal, what is left of the plan is empty: only their sums were shuffled."""
    a = spark.range(50_000).select("id", (F.col("id") % 7).alias("x"))
    found = quality.bag_difference(a, a.repartition(3))
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert "SortMergeJoin" not in final.split("Exchange")[0] and "EmptyRelation" in final or "LocalTableScan" in final
