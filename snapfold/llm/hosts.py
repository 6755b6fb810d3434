r"""URL filter by host reputation: rules first, then an empirical-Bayes judgement of the host, with DataFrame functions only.

Outcomes of labelled pages (bad or not) are counted by host, registered domain and public suffix. At each level the rates of
the children of a parent are taken as draws from a beta distribution about the parent's rate, whose strength (prior pages) is
estimated from all of them by moments: with k bad of n pages in a child and K of N in its parent,

    within  = sum k(k-1) / sum n(n-1)                        the mean of squared child rates
    between = sum (K^2 - sum k^2) / sum (N^2 - sum n^2)      the mean of squared parent rates, from pairs of different children
    share   = (within - between) / (K/N - between)           the part of the variance that lies between children
    prior   = 1/share - 1, held between LEAST and MOST

Both moments are unbiased whatever the sizes, and every sum is of whole numbers, so the order of rows doesn't matter. A
child's posterior has the parent's posterior mean as prior mean; a host without labels has its domain's, and so on up. A page
is blocked if even the lower bound of its host's bad rate (mean less ``SURE`` standard deviations) is above ``TOLERATED``.

Rules (action, host, path) come first: a rule fits its host and all subdomains, if the path starts with the rule's; the
longest that fits decides, of two equally long ones that with the longer host, then the one named first. They are a short
list, part of the plan.

Defined cases: a null url, or one without ``://``, has an empty host and an empty path; the empty host is judged like another.
User name and port are part of ``host`` but not of the name that is judged. Hosts of digits and dots are their own domain
and suffix. Labels of one id are merged, bad if any says so; a label that says nothing is none, a null id has none. Repeated
pages and pages of equal id are each judged and each counted. Without any label the rate of all is one half and nothing is
blocked. An empty table gives an empty result; other columns of the input are not looked at.

Counts are summed before they are shuffled, so a hot host costs a row a task; where pages meet their host's verdict, the host
table is the side of one row a host, and Spark splits a skewed host of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (action, host, path)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Second labels that with a country's two letters make a public suffix.
SECOND = ["ac", "co", "com", "edu", "gov", "net", "org"]
LEAST, MOST = 1.0, 1000.0
SURE, TOLERATED = 1.2816, 0.25
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ["suffix", "domain", "name"]


def located(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path of ``url``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substr("url", at + 3)).otherwise("")
    out = pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    path = F.regexp_extract(F.substr("_rest", F.char_length("_host") + 1), r"^[^?#]*", 0)
    return out.withColumns({"path": path, "host": F.translate("_host", UPPER, LOWER)}).drop("_rest", "_host")


def named(pages: DataFrame) -> DataFrame:
    """``pages`` with the name, registered domain and public suffix of ``host``."""
    out = pages.withColumn("name", F.regexp_replace("host", r"^.*@|:[0-9]*$", ""))
    labels = F.split("name", r"\.")
    last, before = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
    two = F.coalesce(last.rlike("^[a-z]{2}$") & before.isin(SECOND), F.lit(False))
    bare = F.col("name").rlike(r"^[0-9.]+$")
    end = lambda n: F.when(bare, F.col("name")).otherwise(F.substring_index("name", ".", n))
    return out.withColumns({"suffix": F.when(two, end(-2)).otherwise(end(-1)), "domain": F.when(two, end(-3)).otherwise(end(-2))})


def ruled(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule of ``host`` and ``path``, null if none fits, and its action."""
    def fits(host: str, path: str) -> Column:
        return ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))

    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    none = F.lit(None).cast("string")
    return F.coalesce(*[F.when(fits(h, p), h + p) for _, h, p in order], none), F.coalesce(*[F.when(fits(h, p), a) for a, h, p in order], none)


def _prior(children: DataFrame, parents: DataFrame, on: list[str], name: str) -> DataFrame:
    """One row with the prior's strength: how many pages a parent's rate counts for in its children."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    one = children.groupBy(*on).agg(F.sum(k * k).alias("kk"), F.sum(n * n).alias("nn"), F.sum(k * (k - 1)).alias("kw"), F.sum(n * (n - 1)).alias("nw"))
    both = one.join(parents, on) if on else one.join(F.broadcast(parents))
    total = both.agg(F.sum("kw").alias("kw"), F.sum("nw").alias("nw"), F.sum(k * k - F.col("kk")).alias("kb"), F.sum(n * n - F.col("nn")).alias("nb"), F.sum(k).alias("k"), F.sum(n).alias("n"))
    mean = F.try_divide("k", "n")
    between = F.coalesce(F.try_divide("kb", "nb"), mean * mean)
    share = F.try_divide(F.try_divide("kw", "nw") - between, mean - between)
    strength = F.when(share <= 1 / (1 + MOST), MOST).otherwise(F.greatest(F.try_divide(F.lit(1.0), share) - 1, F.lit(LEAST)))
    return total.select(F.coalesce(strength, F.lit(MOST)).alias(name))


def reputations(counts: DataFrame) -> DataFrame:
    """(suffix, domain, name, n, k), one row a name, to the posterior of each: mean ``rate`` and lower bound ``rate_least``."""
    of = {2: counts}
    for i in (1, 0):
        of[i] = of[i + 1].groupBy(*LEVELS[: i + 1]).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    everything = of[0].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    known = everything.select(((F.col("k") + 0.5) / (F.col("n") + 1.0)).alias("_rate"))
    for i in range(3):
        on = LEVELS[:i]
        prior = _prior(of[i], of[i - 1] if i else everything, on, "_prior")
        rows = (of[i].join(known, on) if on else of[i].join(F.broadcast(known))).join(F.broadcast(prior))
        # one row a parent at most, and one row of the prior: bounded by the level above
        a, size = F.col("_prior") * F.col("_rate") + F.col("k"), F.col("_prior") + F.col("n")
        rows = rows.withColumns({"rate": a / size, "_size": size})
        known = rows.select(*LEVELS[: i + 1], F.col("rate").alias("_rate"))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("_size") + 1))
    return rows.select(*LEVELS, "n", "k", "rate", (F.col("rate") - SURE * spread).alias("rate_least"))


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, url and labels (page_id, bad) to page_id, host, path, rule, verdict, and what the method thinks of the host."""
    said = labels.where("page_id is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    rows = named(located(pages.select("page_id", "url")))
    counts = rows.select("page_id", *LEVELS).join(said, "page_id", "left").groupBy(*LEVELS).agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    known = reputations(counts).select("name", "rate", "rate_least")
    rule, action = ruled(rules)
    method = F.when(F.col("rate_least") > TOLERATED, "block").otherwise("allow")
    return rows.join(known, "name", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, method).alias("verdict"), F.round("rate", 9).alias("rate"), F.round("rate_least", 9).alias("rate_least"))


def query(spark, sf_dir: str) -> DataFrame:
    """Labels are those of the documents that the pages were made of, by id: a page is bad if it is toxic or of low quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    none = F.coalesce("quality", "toxic").isNull()
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), labels.select(F.col("doc_id").alias("page_id"), F.when(~none, bad).alias("bad")))


def _level_sql(i: int) -> str:
    """SQL of a level: its prior's strength p{i} and its posterior r{i}."""
    on = LEVELS[:i]
    keys, parent = ", ".join(LEVELS[: i + 1]), f"c{i - 1}" if i else "c_all"
    group, join = (f"GROUP BY {', '.join(on)}", f"USING ({', '.join(on)})") if on else ("", "ON true")
    above = f"r{i - 1}" if i else "r_all"
    return f"""
m{i} AS (SELECT {', '.join(on) + ', ' if on else ''}sum(k::DOUBLE * k) AS kk, sum(n::DOUBLE * n) AS nn, sum(k::DOUBLE * (k - 1)) AS kw, sum(n::DOUBLE * (n - 1)) AS nw FROM c{i} {group}),
t{i} AS (SELECT sum(kw) AS kw, sum(nw) AS nw, sum(k::DOUBLE * k - kk) AS kb, sum(n::DOUBLE * n - nn) AS nb, sum(k::DOUBLE) / nullif(sum(n::DOUBLE), 0) AS mean FROM m{i} JOIN {parent} {join}),
b{i} AS (SELECT *, coalesce(kb / nullif(nb, 0), mean * mean) AS between_ FROM t{i}), h{i} AS (SELECT (kw / nullif(nw, 0) - between_) / nullif(mean - between_, 0) AS share FROM b{i}),
p{i} AS (SELECT coalesce(CASE WHEN share <= {1 / (1 + MOST)!r} THEN {MOST} ELSE greatest(1.0 / share - 1, {LEAST}) END, {MOST}) AS prior FROM h{i}),
r{i} AS (SELECT {keys}, (prior * {above}.rate + c{i}.k) / (prior + c{i}.n) AS rate, prior + c{i}.n AS size FROM c{i} JOIN {above} {join} CROSS JOIN p{i})"""


def _sql() -> str:
    order = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule, action = ("CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v(a, h, p)}'" for a, h, p in order) + " END" for v in (lambda a, h, p: h + p, lambda a, h, p: a))
    seconds = ", ".join(f"'{s}'" for s in SECOND)
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
g AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u),
i AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host, path FROM g),
j AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM i),
k AS (SELECT *, string_split(name, '.') AS l, regexp_matches(name, '^[0-9.]+$') AS bare FROM j),
s AS (SELECT *, len(l) > 1 AND regexp_matches(l[-1], '^[a-z][a-z]$') AND coalesce(l[-2], '') IN ({seconds}) AS two FROM k),
rows_ AS (SELECT page_id, host, path, name, CASE WHEN bare THEN name WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix, CASE WHEN bare THEN name WHEN two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM s),
said AS (SELECT doc_id AS page_id, max(CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
c2 AS (SELECT suffix, domain, name, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k FROM rows_ LEFT JOIN said USING (page_id) GROUP BY ALL),
c1 AS (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM c2 GROUP BY ALL), c0 AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM c1 GROUP BY ALL),
c_all AS (SELECT coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(k), 0)::BIGINT AS k FROM c0), r_all AS (SELECT (k + 0.5::DOUBLE) / (n + 1.0::DOUBLE) AS rate FROM c_all),
{','.join(_level_sql(i) for i in range(3))},
f AS (SELECT name, rate, rate - {SURE}::DOUBLE * sqrt(rate * (1 - rate) / (size + 1)) AS least FROM r2)
SELECT page_id, host, path, {rule} AS rule, coalesce({action}, CASE WHEN least > {TOLERATED} THEN 'block' ELSE 'allow' END) AS verdict, round(rate, 9) AS rate, round(least, 9) AS rate_least FROM rows_ LEFT JOIN f USING (name)
"""


SQL = _sql()
