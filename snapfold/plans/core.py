"""Queries of canonical rows, lifecycle and links, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import age_days
from ..operators import dedup, lifecycle, links
from .binding import EVENTS_SQL, day_text, events, iso, table


def canonical_daily(spark, d):
    rows = dedup.canonical(events(spark, d), ["user_id", "day"], ["rank", "ts", "event_id"])
    return rows.select("user_id", day_text("day"), "event_type", "event_id", F.round("value", 6).alias("value"))


def first_seen(spark, d):
    out = dedup.first_seen(events(spark, d), "user_id", "day", "rank", "event_type")
    return out.select("user_id", day_text("first_day"), "first_source", age_days(F.lit("2023-12-25T10:00:00Z"), F.col("first_day")).alias("age_days"))


def strict_conflicts(spark, d):
    return dedup.conflicts(events(spark, d), ["user_id", "day", "event_type"], "value").withColumn("day", iso("day"))


def latest_per_key(spark, d):
    """The newest order of each customer up to a cutoff, and on how many days there was one."""
    orders = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    out = dedup.latest(orders, "o_custkey", "o_orderdate", ["o_orderpriority", (-F.col("o_orderkey")).alias("_last")], "day", F.lit("2001-01-01").cast("timestamp"))
    return out.select("o_custkey", "o_orderkey", day_text("day"), "o_orderpriority", "n_days")


def strict_canonical(spark, d):
    """Customers' days whose orders of one priority differ have no canonical row."""
    orders = table(spark, d, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus", "o_orderpriority")
    good, bad = dedup.strict_canonical(orders, ["o_custkey", "month"], "o_orderstatus", ["F", "O", "P"])
    return good.select("o_custkey", "month", "o_orderstatus", F.col("o_orderpriority").alias("what")).unionByName(bad.select("o_custkey", "month", "o_orderstatus", F.concat(F.lit("conflict:"), "n_kinds").alias("what")))


def latest_batch(spark, d):
    rows = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return dedup.latest_batch(rows, ["o_orderpriority", "month"], "o_orderdate").select("o_orderpriority", "month", "o_orderkey", F.round("o_totalprice", 6).alias("total"))


def repeat_suppression(spark, d):
    rows = dedup.without_repeats(events(spark, d), ["user_id"], ["ts", "event_id"], "event_type")
    return rows.select("user_id", "event_id", "event_type")


def overlay(spark, d):
    rows = events(spark, d).withColumn("tag", F.concat(F.lit("p"), F.col("event_id")))
    out = dedup.overlay(rows, ["user_id", "day"], ["rank", "ts", "event_id"], F.col("event_type") == "purchase", "tag")
    return out.select("user_id", day_text("day"), "event_id", "tag")


def ranked_dedup(spark, d):
    orders = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    early = orders.where("o_orderstatus = 'O'").withColumn("source_rank", F.lit(0))
    late = orders.withColumn("source_rank", F.lit(1))
    both = early.unionByName(late)
    first = dedup.canonical(both, ["o_custkey", "month"], ["source_rank", "o_orderdate", "o_orderkey"])
    last = dedup.canonical(both, ["o_custkey", "month"], [F.desc("source_rank"), F.desc("o_orderdate"), F.desc("o_orderkey")])
    return first.select("o_custkey", "month", F.col("o_orderkey").alias("first_key"), F.col("source_rank").alias("first_rank")).join(
        last.select("o_custkey", "month", F.col("o_orderkey").alias("last_key")), ["o_custkey", "month"]
    )


HORIZONS = [1, 3, 7, 14]


def _outcomes(spark, d):
    listed = events(spark, d).groupBy("user_id", "day").agg(F.bool_or(F.col("event_type") == "purchase").alias("listed"))
    rows = dedup.canonical(events(spark, d), ["user_id", "day"], ["rank", "ts", "event_id"]).select("user_id", "day", "value").join(listed, ["user_id", "day"])
    last = table(spark, d, "events").agg(F.max(F.to_date("ts")).alias("_latest"))
    return lifecycle.horizons(rows.join(F.broadcast(last)), "user_id", "day", "value", "listed", HORIZONS)


def horizon_outcomes(spark, d):
    return _outcomes(spark, d).withColumn("first_day", iso("first_day")).withColumn("milestone", F.round("milestone", 6))


def cohort_metrics(spark, d):
    return lifecycle.cohort_metrics(_outcomes(spark, d))


def horizon_counts(spark, d):
    """Primary are those whose first event is a purchase or a signup."""
    first = events(spark, d).groupBy("user_id").agg(F.min_by("event_type", F.struct("day", "rank")).alias("first_type"))
    outcomes = _outcomes(spark, d).join(first, "user_id")
    return lifecycle.horizon_counts(outcomes, F.col("first_type").isin("purchase", "signup"), lifecycle_events(spark, d), "kind")


def _firsts(spark, d):
    c = {"first_purchase": F.col("event_type") == "purchase", "first_error": F.col("event_type") == "error", "first_large": F.col("value") > 90}
    return lifecycle.firsts(events(spark, d), "user_id", "day", c)


def conditional_firsts(spark, d):
    return _firsts(spark, d).select("user_id", *[day_text(c) for c in ("first_day", "first_purchase", "first_error", "first_large")])


def lifecycle_events(spark, d):
    return lifecycle.as_events(_firsts(spark, d), "user_id", ["first_purchase", "first_error", "first_large"]).withColumn("day", iso("day"))


def entry_curve(spark, d):
    f = _firsts(spark, d).select(F.date_diff("first_purchase", "first_day").alias("offset"))
    return lifecycle.entry_curve(f, "offset", 14)


def weekly_rates(spark, d):
    return lifecycle.mature_weeks(cohort_metrics(spark, d), 7)


def resolved_dates(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    refs = o.join(li, o["o_orderkey"] == li["l_orderkey"]).select("o_custkey", "l_partkey", F.to_date("o_orderdate").alias("day"))
    first = li.groupBy("l_partkey").agg(F.min(F.to_date("l_shipdate")).alias("seen"))
    return lifecycle.resolved_dates(refs, first, "o_custkey", "l_partkey", "day", "seen").withColumn("resolved", iso("resolved"))


def link_spans(spark, d):
    li = table(spark, d, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return links.spans(li, "l_partkey", "l_suppkey", "day").withColumn("first_day", iso("first_day")).withColumn("last_day", iso("last_day"))


def edges_with_status(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    known = table(spark, d, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    looked = table(spark, d, "part").where("p_size > 40").select(F.col("p_partkey").alias("l_partkey"), F.lit("missing").alias("lookup"))
    return links.with_status(li, known, looked, "l_partkey", "lookup")


def firsts_attached(spark, d):
    li = table(spark, d, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    out = links.firsts_attached(li, "l_partkey", "l_suppkey", "day")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day_text("first_outer"), day_text("first_pair"))


def route_dates(spark, d):
    edges = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min("l_shipdate").alias("day"))
    out = edges.groupBy("l_partkey").agg(F.to_date(F.min("day")).alias("first_day"), F.count("l_suppkey").alias("n_suppliers"))
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"))
    return parts.join(out, "l_partkey", "left").select("l_partkey", day_text("first_day"), F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"))


def spellings(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("word")).where("word <> ''")
    return links.spellings(words, "word")


def set_overlap(spark, d):
    o = table(spark, d, "orders")
    done, rest = (o.where(f"o_orderstatus {x} 'F'").select(F.col("o_custkey").alias("k")).distinct() for x in ("=", "<>"))
    return links.overlap(done, rest, "k")


_CANON = f"""{EVENTS_SQL},
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rank, ts, event_id) AS n FROM e) WHERE n = 1)"""
_OUTCOMES = f"""{_CANON},
p AS (SELECT user_id, day, bool_or(event_type = 'purchase') AS listed FROM e GROUP BY ALL),
f AS (SELECT user_id, min(day) AS first_day FROM e GROUP BY user_id),
r AS (SELECT c.user_id, c.value, p.listed, f.first_day, date_diff('day', f.first_day, c.day) AS o, h.horizon
      FROM c JOIN p USING (user_id, day) JOIN f USING (user_id) CROSS JOIN (SELECT unnest([1, 3, 7, 14])::INT AS horizon) h),
g AS (SELECT user_id, first_day, horizon,
        arg_min(CASE WHEN o IN (horizon, horizon + 1) THEN value END, CASE WHEN o IN (horizon, horizon + 1) THEN o END) AS m,
        count(DISTINCT CASE WHEN listed AND o > 0 AND o <= horizon THEN o END) AS k,
        date_diff('day', first_day, (SELECT max(day) FROM e)) >= horizon + 1 AS eligible
      FROM r GROUP BY ALL),
x AS (SELECT user_id, first_day, horizon, eligible, CASE WHEN eligible THEN m END AS milestone,
        CASE WHEN eligible THEN k > 0 END AS entered, CASE WHEN eligible AND k > 0 THEN k >= 3 END AS sustained FROM g)"""
_METRICS = f"""{_OUTCOMES},
m AS (SELECT strftime(first_day, '%G-W%V') AS week, horizon, count(*) AS size, count_if(eligible) AS n_eligible, count(milestone) AS n_observed,
        count_if(entered) AS n_entered, count_if(sustained) AS n_sustained, round(median(milestone), 6) AS median_milestone,
        round(count_if(entered) / nullif(count_if(eligible), 0), 6) AS entry_rate, round(count_if(sustained) / nullif(count_if(eligible), 0), 6) AS sustained_rate
      FROM x GROUP BY ALL)"""
_FIRSTS = f"""{EVENTS_SQL},
f AS (SELECT user_id, min(day) AS first_day, min(CASE WHEN event_type = 'purchase' THEN day END) AS first_purchase,
        min(CASE WHEN event_type = 'error' THEN day END) AS first_error, min(CASE WHEN value > 90 THEN day END) AS first_large FROM e GROUP BY user_id)"""

QUERIES = {f.__name__: f for f in (
    horizon_counts, canonical_daily, first_seen, strict_conflicts, strict_canonical, latest_per_key, latest_batch, repeat_suppression, overlay, ranked_dedup, horizon_outcomes, cohort_metrics,
    conditional_firsts, lifecycle_events, entry_curve, weekly_rates, resolved_dates, link_spans, edges_with_status, firsts_attached, route_dates, spellings, set_overlap,
)}

ORACLES = {
    "canonical_daily": f"{_CANON} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, event_type, event_id, round(value, 6) AS value FROM c",
    "first_seen": f"""{EVENTS_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day, rank, event_type) AS n FROM e)
        SELECT user_id, strftime(day, '%Y-%m-%d') AS first_day, event_type AS first_source, date_diff('day', DATE '2023-12-25', day)::INT AS age_days FROM f WHERE n = 1""",
    "strict_conflicts": f"{EVENTS_SQL} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, event_type, count(DISTINCT value) AS n_values, count(*) AS n_rows FROM e GROUP BY user_id, e.day, event_type HAVING count(DISTINCT value) > 1",
    "latest_per_key": """WITH u AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2001-01-01'), o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey DESC) AS n,
        FROM u), k AS (SELECT o_custkey, count(DISTINCT o_orderdate::DATE) AS n_days FROM u GROUP BY 1)
        SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority, n_days FROM o JOIN k USING (o_custkey) WHERE n = 1""",
    "strict_canonical": """WITH k AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS p, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS r FROM orders GROUP BY 1, 2, 3),
        w AS (SELECT *, max(n) OVER (PARTITION BY o_custkey, month) AS worst, row_number() OVER (PARTITION BY o_custkey, month ORDER BY r) AS i FROM k)
        SELECT o_custkey, month, o_orderstatus, p AS what FROM w WHERE worst = 1 AND i = 1 UNION ALL SELECT o_custkey, month, o_orderstatus, 'conflict:' || n FROM w WHERE n > 1""",
    "latest_batch": """WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, max(o_orderdate) OVER (PARTITION BY o_orderpriority, strftime(o_orderdate, '%Y-%m')) AS newest FROM orders)
        SELECT o_orderpriority, month, o_orderkey, round(o_totalprice, 6) AS total FROM o WHERE o_orderdate = newest""",
    "repeat_suppression": f"""{EVENTS_SQL}, l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM e)
        SELECT user_id, event_id, event_type FROM l WHERE p IS DISTINCT FROM event_type""",
    "overlay": f"""{_CANON}, t AS (SELECT * FROM (SELECT user_id, day, event_id, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS n FROM e WHERE event_type = 'purchase') WHERE n = 1)
        SELECT c.user_id, strftime(c.day, '%Y-%m-%d') AS day, c.event_id, 'p' || t.event_id AS tag FROM c LEFT JOIN t ON t.user_id = c.user_id AND t.day = c.day""",
    "ranked_dedup": """WITH b AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, 0 AS r FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT *, strftime(o_orderdate, '%Y-%m'), 1 FROM orders),
        n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, month ORDER BY r, o_orderdate, o_orderkey) AS a, row_number() OVER (PARTITION BY o_custkey, month ORDER BY r DESC, o_orderdate DESC, o_orderkey DESC) AS z FROM b)
        SELECT o_custkey, month, max(CASE WHEN a = 1 THEN o_orderkey END) AS first_key, max(CASE WHEN a = 1 THEN r END) AS first_rank, max(CASE WHEN z = 1 THEN o_orderkey END) AS last_key FROM n GROUP BY ALL""",
    "horizon_outcomes": f"{_OUTCOMES} SELECT user_id, strftime(first_day, '%Y-%m-%d') AS first_day, horizon, eligible, round(milestone, 6) AS milestone, entered, sustained FROM x",
    "cohort_metrics": f"{_METRICS} SELECT * FROM m",
    "horizon_counts": f"""{_OUTCOMES}, ft AS (SELECT user_id, arg_min(event_type, {{'d': day, 'r': rank}}) IN ('purchase', 'signup') AS prim FROM e GROUP BY 1), xp AS (SELECT x.*, prim FROM x JOIN ft USING (user_id)),
        hf AS (SELECT user_id, min(CASE WHEN event_type = 'purchase' THEN day END) AS a, min(CASE WHEN event_type = 'error' THEN day END) AS b, min(CASE WHEN value > 90 THEN day END) AS c FROM e GROUP BY 1)
        SELECT 'eligible_primary' AS measure, horizon::VARCHAR AS label, count_if(prim AND eligible) AS n FROM xp GROUP BY horizon UNION ALL SELECT 'entities', 'all', count(DISTINCT user_id) FROM xp UNION ALL SELECT 'entities', 'primary', count(DISTINCT CASE WHEN prim THEN user_id END) FROM xp
        UNION ALL SELECT 'events', 'first_purchase', count(a) FROM hf UNION ALL SELECT 'events', 'first_error', count(b) FROM hf UNION ALL SELECT 'events', 'first_large', count(c) FROM hf""",
    "conditional_firsts": f"{_FIRSTS} SELECT user_id, strftime(first_day, '%Y-%m-%d') AS first_day, strftime(first_purchase, '%Y-%m-%d') AS first_purchase, strftime(first_error, '%Y-%m-%d') AS first_error, strftime(first_large, '%Y-%m-%d') AS first_large FROM f",
    "lifecycle_events": f"""{_FIRSTS}, u AS (SELECT user_id, first_day, 'first_purchase' AS kind, first_purchase AS day FROM f UNION ALL SELECT user_id, first_day, 'first_error', first_error FROM f UNION ALL SELECT user_id, first_day, 'first_large', first_large FROM f)
        SELECT user_id, kind, strftime(day, '%Y-%m-%d') AS day, day = first_day AS left_censored FROM u WHERE u.day IS NOT NULL""",
    "entry_curve": f"""{_FIRSTS}, s AS (SELECT unnest(range(15))::INT AS day), k AS (SELECT date_diff('day', first_day, first_purchase) AS o FROM f)
        SELECT day, (SELECT count(*) FROM k WHERE o BETWEEN 0 AND s.day) AS n_entered, (SELECT count(*) FROM k) AS cohort, round((SELECT count(*) FROM k WHERE o BETWEEN 0 AND s.day) / (SELECT count(*) FROM k), 6) AS share FROM s""",
    "weekly_rates": f"""{_METRICS}, ripe AS (SELECT * FROM m WHERE horizon = 7 AND n_eligible = size)
        SELECT week, sum(size)::BIGINT AS size, sum(n_entered)::BIGINT AS n_entered, round(sum(n_entered) / sum(size), 6) AS rate FROM ripe GROUP BY week
        UNION ALL SELECT 'all', sum(size)::BIGINT, sum(n_entered)::BIGINT, round(sum(n_entered) / sum(size), 6) FROM ripe""",
    "resolved_dates": """WITH r AS (SELECT o_custkey, l_partkey, o_orderdate::DATE AS day FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
        s AS (SELECT l_partkey, min(l_shipdate::DATE) AS seen FROM lineitem GROUP BY 1), f AS (SELECT o_custkey, min(day) AS referred FROM r GROUP BY 1)
        SELECT o_custkey, strftime(min(greatest(referred, seen)), '%Y-%m-%d') AS resolved FROM r JOIN f USING (o_custkey) JOIN s USING (l_partkey) GROUP BY o_custkey""",
    "link_spans": "SELECT l_partkey, l_suppkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, strftime(max(l_shipdate), '%Y-%m-%d') AS last_day, count(*) AS n_rows FROM lineitem GROUP BY 1, 2",
    "edges_with_status": """SELECT DISTINCT l_partkey, l_suppkey, CASE WHEN p_size <= 25 THEN 'resolved' WHEN p_size > 40 THEN 'missing' ELSE 'not_looked_up' END AS status
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "firsts_attached": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(min(l_shipdate) OVER (PARTITION BY l_partkey), '%Y-%m-%d') AS first_outer,
        strftime(min(l_shipdate) OVER (PARTITION BY l_partkey, l_suppkey), '%Y-%m-%d') AS first_pair FROM lineitem""",
    "route_dates": """SELECT p_partkey AS l_partkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, count(DISTINCT l_suppkey) AS n_suppliers FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""",
    "spellings": """WITH w AS (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS word FROM documents)
        SELECT lower(word) AS canonical, string_agg(DISTINCT word, ',' ORDER BY word) AS spellings, count(*) AS n_rows FROM w WHERE word <> '' GROUP BY 1 HAVING count(DISTINCT word) > 1""",
    "set_overlap": """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus <> 'F')
        SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM a JOIN b USING (k)) AS n_both, (SELECT count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)) AS n_union""",
}
