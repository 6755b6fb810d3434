"""Scans in pieces, look-ups and overlapping intervals: keys with many rows, against plain versions."""

import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from snapfold.operators import temporal, usage

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def line(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(30)}", T0 + timedelta(minutes=rng.randrange(400)), i, i if rng.random() < 0.05 else None, f"v{i}" if rng.random() < 0.02 else None) for i in range(6000)]
    rows += [(None, T0, 7000, 1, "n"), (None, T0 + timedelta(1), 7001, None, None), ("hot", None, 7002, 5, None)]
    return spark.createDataFrame(rows, "key string, at timestamp_ntz, n long, a long, `b` string")


@pytest.mark.parametrize("most", [100, 10**9])
def test_last_known_equals_the_window(line, most):
    w = Window.partitionBy("key").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0)
    expected = line.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("a", "b")})
    got = temporal.last_known(line, "key", ["at", "n"], ["a", "b"], most)
    assert got.columns == line.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_a_hot_key_is_shared_by_tasks(line):
    cut = temporal.pieces(line, "key", "at", 100)
    sizes = {(r["key"], r["_piece"]): r["count"] for r in cut.groupBy("key", "_piece").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) > 100 and max(hot) < sum(hot) / 20
    assert all(p == 0 for k, p in sizes if k is None)


def test_validity_of_a_hot_key_in_pieces(spark, line):
    """A hot key's intervals are those of one window over it, and no task of a window has all of its rows."""
    states = line.select("key", "at", "n", F.when(F.col("n") % 7 != 0, F.floor(F.col("n") / 3) % 2).alias("level"))
    told = [sorted(map(str, temporal.validity(states, "key", ["at", "n"], "level", most).collect())) for most in (None, 100)]
    assert told[0] == told[1]
    plan = temporal.validity(states, "key", ["at", "n"], "level", 100)._jdf.queryExecution().executedPlan().toString()
    assert "_piece" in plan


def test_pieces_are_the_same_for_all_that_read_them(spark, line):
    """Quantiles depend on the order of arrival, here on chance: what a piece hands on must come from the pieces that were scanned."""

    def some(batches):
        import random

        import pyarrow as pa

        for b in batches:
            yield b.filter(pa.array([random.SystemRandom().random() < 0.3 for _ in range(b.num_rows)]))

    w = Window.partitionBy("key").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0)
    expected = sorted(map(str, line.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("a", "b")}).collect()))
    spark.conf.set("spark.sql.exchange.reuse", "false")  # on a cluster whether Spark reuses the quantiles is a race
    try:
        got = temporal.last_known(line, "key", ["at", "n"], ["a", "b"], 100, by=line.mapInArrow(some, line.schema))
        assert sorted(map(str, got.collect())) == expected
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_as_of_keeps_every_probe(spark):
    intervals = spark.createDataFrame([("a", T0, T0 + timedelta(2), "x"), ("a", T0 + timedelta(2), None, "y"), ("b", T0, T0, "never"), (None, T0, None, "z")], "key string, valid_from timestamp_ntz, valid_to timestamp_ntz, state string")
    probes = spark.createDataFrame([(1, "a", T0), (1, "a", T0), (2, "a", T0 + timedelta(2)), (3, "a", T0 - timedelta(1)), (4, "b", T0), (5, None, T0), (6, "a", None)], "id long, key string, at timestamp_ntz")
    for most in (1, 10**9):
        got = sorted((r["id"], r["state"]) for r in temporal.as_of(probes, intervals, "key", "at", ["state"], most).collect())
        assert got == [(1, "x"), (1, "x"), (2, "y"), (3, None), (4, None), (5, None), (6, None)]


def test_open_sets(spark):
    d = lambda n: date(2024, 1, n) if n else None
    rows = [("a", "x", d(1), d(5)), ("a", "y", d(3), None), ("a", "x", d(4), d(8)), ("b", "x", d(2), d(2)), ("b", "y", d(3), d(4)), ("c", "x", d(5), d(4)), ("c", "x", None, d(4)), (None, "x", d(1), None), ("d", "x", d(1), d(2)), ("d", "x", d(3), d(4))]
    got = sorted(map(tuple, temporal.open_sets(spark.createDataFrame(rows, "key string, target string, f date, u date"), "key", "target", "f", "u").collect()))
    assert [g for g in got if g[0] == "b"] == [("b", d(2), d(3), ["x"]), ("b", d(3), d(5), ["y"])]
    assert [g for g in got if g[0] == "a"] == [("a", d(1), d(3), ["x"]), ("a", d(3), d(9), ["x", "y"]), ("a", d(9), None, ["y"])]
    assert [g for g in got if g[0] == "d"] == [("d", d(1), d(5), ["x"])]
    held = {(k, day): sorted({t for kk, t, f, u in rows if kk == k and f and (u is None or f <= u) and f <= day and (u is None or day <= u)}) for k in "abcd" for day in map(d, range(1, 12))}
    for (k, day), expected in held.items():
        assert [g[3] for g in got if g[0] == k and g[1] <= day and (g[2] is None or day < g[2])] == ([expected] if expected else []), (k, day)


def test_in_force_against_all_pairs(spark):
    rng = random.Random(4)
    day = lambda: date(2024, 1, 1) + timedelta(rng.randrange(60))
    facts = [(i, f"k{rng.randrange(4)}" if i % 20 else None, day() if i % 17 else None) for i in range(400)] + [(7, "k1", date(2024, 1, 9))] * 2
    ledger = [(f"k{rng.randrange(4)}", rng.choice(["p", "q", "r"]), a := day(), a + timedelta(rng.randrange(9)) if rng.random() < 0.8 else None, "who" if rng.random() < 0.8 else None, "ref") for _ in range(60)]
    got = usage.in_force(spark.createDataFrame(facts, "id long, key string, day date"), spark.createDataFrame(ledger, "key string, target string, valid_from date, valid_until date, reviewer string, evidence string"), "key", "day")
    expected = []
    for i, k, at in facts:
        targets = sorted({t for kk, t, a, z, who, _ in ledger if who and kk == k and at and a <= at <= (z or at)})
        expected.append((i, k, at, targets, "unresolved" if not targets else "curated" if len(targets) == 1 else "ambiguous"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_in_force_costs_the_sum_on_one_key(spark):
    """A hundred thousand facts and as many overlapping reviews of one key: ten thousand million pairs, if they were made."""
    n = 100_000
    facts = spark.range(n).select(F.lit("k").alias("key"), F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") % 40_000).cast("int")).alias("day"), "id")
    start = F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") * 2 / 5).cast("int"))
    ledger = spark.range(n).select(F.lit("k").alias("key"), F.concat(F.lit("t"), F.col("id") % 3).alias("target"), start.alias("valid_from"), F.date_add(start, 3).alias("valid_until"), F.lit("w").alias("reviewer"), F.lit("e").alias("evidence"))
    began = time.time()
    got = usage.in_force(facts, ledger, "key", "day").agg(F.count("*").alias("n"), F.sum(F.size("targets")).alias("m")).first()
    assert got["n"] == n and got["m"] == 3 * n and time.time() - began < 60
