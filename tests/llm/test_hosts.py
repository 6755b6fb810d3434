"""Host reputation: urls, rules, and the estimate against one written with plain numbers."""

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from snapfold.llm import hosts

URLS = [
    ("http://A.Example.com:80/en/x?q=/es/", "a.example.com:80", "/en/x", "a.example.com", "example.com", "com"),
    ("https://u@www.shop.co.uk?x", "u@www.shop.co.uk", "", "www.shop.co.uk", "shop.co.uk", "co.uk"),
    ("x://10.0.0.1/a#b", "10.0.0.1", "/a", "10.0.0.1", "10.0.0.1", "10.0.0.1"),
    ("http://com", "com", "", "com", "com", "com"),
    ("http://É.fr/a\nb#c", "É.fr", "/a\nb", "É.fr", "É.fr", "fr"),
    ("http:/x.com/", "", "", "", "", ""),
    ("http://a.com/go?to=http://b.com/", "a.com", "/go", "a.com", "a.com", "com"),
    (None, "", "", "", "", ""),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, name string")
    got = {r["page_id"]: tuple(r[c] for c in ("host", "path", "name", "domain", "suffix")) for r in hosts.named(hosts.located(pages)).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}


def test_rules(spark):
    cases = [
        ("http://example.com/en/", "example.com/en/", "block"), ("http://www.example.com/en/1", "www.example.com/en/", "allow"), ("http://a.www.example.com/en/1", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/", "com/", "allow"), ("http://a.com", None, None), ("http://net/fr/", "net/fr/", "block"), ("http://a.net/en/", None, None), ("http://x.example.com/de", "com/", "allow"), ("http://net.org/es/", None, None),
    ]
    pages = hosts.located(spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "page_id long, url string"))
    rule, action = hosts.ruled(hosts.RULES)
    assert [(r["rule"], r["action"]) for r in pages.select("page_id", rule.alias("rule"), action.alias("action")).orderBy("page_id").collect()] == [c[1:] for c in cases]


def plain(counts):
    """The posterior of each host, level by level, with Python numbers."""
    levels = [defaultdict(lambda: [0, 0]) for _ in range(4)]
    for key, (n, k) in counts.items():
        for i in range(4):
            levels[i][key[:i]][0] += n
            levels[i][key[:i]][1] += k
    n, k = levels[0][()]
    known, size = {(): (k + 0.5) / (n + 1)}, {}
    for i in (1, 2, 3):
        pairs = [(a, b) for a in levels[i] for b in levels[i] if a != b and a[:-1] == b[:-1]] if len(levels[i]) < 400 else None
        kw, nw = (sum(v[1] * (v[1] - 1) for v in levels[i].values()), sum(v[0] * (v[0] - 1) for v in levels[i].values()))
        kb, nb = (sum(levels[i][a][j] * levels[i][b][j] for a, b in pairs) for j in (1, 0))
        mean = k / n if n else None
        prior = hosts.MOST
        if n:
            between = kb / nb if nb else mean * mean
            if nw and mean != between:
                share = (kw / nw - between) / (mean - between)
                prior = hosts.MOST if share <= 1 / (1 + hosts.MOST) else max(1 / share - 1, hosts.LEAST)
        now = {}
        for key, (m, bad) in levels[i].items():
            now[key], size[key] = (prior * known[key[:-1]] + bad) / (prior + m), prior + m
        known = now
    return {key[2]: (r, r - hosts.SURE * math.sqrt(r * (1 - r) / (size[key] + 1))) for key, r in known.items()}


def test_estimate_against_plain_numbers(spark):
    """Good and bad domains, hosts with many, few and no labels."""
    rng = random.Random(11)
    rows, labels = [], []
    for s in ("com", "org"):
        for d in range(6):
            rate = rng.choice([0.02, 0.1, 0.9])
            for h in range(4):
                for _ in range(rng.choice([0, 1, 5, 60])):
                    i = len(rows)
                    rows.append((i, f"http://h{h}.d{d}.{s}/x"))
                    if rng.random() < 0.7:
                        labels.append((i, rng.random() < rate))
    rows += [(10**6 + i, f"http://new{i}.d{i % 6}.org/") for i in range(6)] + [(7, rows[7][1])]
    got = hosts.judged(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels + labels[:3], "page_id long, bad boolean"), []).collect()
    said, counts = dict(labels), defaultdict(lambda: [0, 0])
    for i, url in rows:
        name = url.split("/")[2]
        h, d, s = name.split(".")
        counts[s, f"{d}.{s}", name][0] += i in said
        counts[s, f"{d}.{s}", name][1] += said.get(i, False)
    known = plain(counts)
    assert len(got) == len(rows) and {"allow", "block"} == {r["verdict"] for r in got}
    for r in got:
        rate, least = known[r["host"]]
        assert abs(r["rate"] - rate) < 1e-8 and abs(r["rate_least"] - least) < 1e-8
        assert r["verdict"] == ("block" if least > hosts.TOLERATED else "allow") and r["rule"] is None


def test_a_host_without_labels_has_its_domains_rate(spark):
    rows = [(i, f"http://{'bad' if i % 2 else 'good'}{i % 8}.{'spam' if i % 2 else 'fine'}.net/") for i in range(400)] + [(1000, "http://other.spam.net/"), (1001, "http://other.fine.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in hosts.judged(pages, pages.where("page_id < 1000").select("page_id", (F.col("page_id") % 2 == 1).alias("bad")), []).collect()}
    assert got[1000] == "block" and got[1001] == "allow"


def test_no_python_in_the_plan(spark, odd):
    plan = hosts.query(spark, odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Scan ExistingRDD"))
