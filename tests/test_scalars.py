"""Decimals of any exponent, JSON of any depth, links to repositories."""

import decimal
import random
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from snapfold.functions import scalars
from snapfold.operators import sampling


def plain(text):
    try:
        n = decimal.Decimal(text)
        if not n.is_finite():
            return None
    except decimal.InvalidOperation:
        return None
    out = format(n, "f")
    out = out.rstrip("0").rstrip(".") if "." in out else out
    return "0" if n == 0 else out


def test_decimals_of_any_exponent(spark):
    rng = random.Random(1)
    texts = ["1e-30", "1.5e-21", "2e50", "0e9", "-0.00", "+1", "1.", ".5", ".", "", "e5", "1e", "0x1", "nan", "Infinity", " 7.0 ", "1_000.50", "--1", "1e+3", "000", "-000.0100E2", "1e99999999999999999999", "9" * 60, "0." + "0" * 50 + "1", "١"]
    for _ in range(300):
        texts.append(f"{rng.choice(['', '-', '+'])}{rng.choice(['', '0', '00', str(rng.randrange(10**9))])}{rng.choice(['', '.', '.' + str(rng.randrange(10**6)) + '00'])}{rng.choice(['', f'e{rng.randint(-60, 60)}', f'E+{rng.randrange(40)}'])}")
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.plain_decimal(F.col("t")).alias("p")).collect()
    assert {r["t"]: r["p"] for r in got if r["t"] not in ("١",)} == {t: plain(t) for t in texts if t != "١"}
    same = spark.createDataFrame([("12e5000", "1.2e5001"), ("1e-5000", "10e-5001"), ("1e5000", "1e5001")], "a string, b string")
    assert [r[0] for r in same.select(scalars.price(F.col("a")).eqNullSafe(scalars.price(F.col("b")))).collect()] == [True, True, False]


def test_leaves_of_deep_json(spark):
    deep = lambda n: "".join('{"k":' for _ in range(n)) + "1" + "}" * n
    leaf = lambda text: spark.createDataFrame([(text,)], "t string").select(scalars.leaves(F.parse_json("t")).alias("m")).first()["m"]
    for n in (1, 7, 12):
        assert leaf(deep(n)) == {".".join("k" * n): "1"}
    assert leaf('{"a":{},"b":null,"c":[{"d":1}]}') == {"c": '[{"d":1}]'}
    with pytest.raises(Exception, match="nested deeper"):
        leaf(deep(13))


URLS = [
    "https://huggingface.co/a/b", "https://www.huggingface.co/a/b/tree/main?x=1#y", "http://HuggingFace.co:80/a/b/", "https://u@huggingface.co/a%2Fb", "https://huggingface.co/a+c/b%20d", "https://huggingface.co/a", "https://huggingface.co//a//b",
    "https://huggingface.co/datasets/a/b", "https://huggingface.co/spaces/a/b", "https://huggingface.co/papers/2301.00001", "https://huggingface.co/collections/a/b", "https://hf.co/a/b", "https://example.com/a/b", "https://huggingface.co.evil.com/a/b", "", None, "not a url",
]


def test_links_to_repositories(spark):
    def expected(url):
        parsed = urlparse(url or "")
        parts = unquote(parsed.path).strip("/").split("/")
        fine = parsed.hostname in ("huggingface.co", "www.huggingface.co") and len(parts) >= 2 and parts[0] not in ("datasets", "spaces", "collections", "papers")
        return "/".join(parts[:2]) if fine else None

    got = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", scalars.repo_of(F.col("u")).alias("r")).collect()
    assert {r["u"]: r["r"] for r in got} == {u: expected(u) for u in URLS}


def test_order_of_observations(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (None, 2)], "o int, f int")
    assert [r[0] for r in df.select(scalars.observation_order(F.col("o"), F.col("f"))).collect()] == ["before_hf", "same_day", "after_hf", "not_observed"]


def test_a_large_group_is_cut_before_it_meets(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit(0).alias("p"), F.lit(None).cast("int").alias("late"), (F.col("id") % 50 == 0).cast("int").alias("g"))
    out = sampling.members(rows, "k", "p", "late", "g", 30, "seed")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 2 and "_part" in plan and out.count() == 30
    turns = out.where("stratum = 'remaining'").join(rows, "k").groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in turns} == {0: 10, 1: 10}
