"""Queries of usage, calendars, quality and marts, bound to the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalars import valid_paper_id
from ..operators import calendar, marts, quality, ranks, usage
from ..session import shared_dir
from ..sources import exports, store
from .binding import EVENTS_SQL, TYPES, day_text, events, iso, table, user_days



def orders(spark, d):
    return table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM")).withColumn("day", F.to_date("o_orderdate"))


def r6(c):
    return F.round(c, 6).alias(c)


def r2(c):
    return F.round(c, 2).alias(c)


def usage_shares(spark, d):
    return usage.shares(orders(spark, d), ["month"], "o_orderpriority", "o_totalprice").select("month", "o_orderpriority", r2("amount"), r2("total"), r6("share_percent"))


def share_denominators(spark, d):
    s = usage.shares(orders(spark, d), ["month"], "o_orderpriority", "o_totalprice")
    s = s.withColumn("share_percent", F.when(F.col("month").endswith("-06") & F.col("o_orderpriority").startswith("1"), F.col("share_percent") - 120).otherwise(F.col("share_percent")))
    return usage.denominators(s, ["month"], "share_percent").select("month", F.round("sum_percent", 4).alias("sum_percent"), "n_outside")


def _attributed(spark, d):
    c = table(spark, d, "customer")
    return orders(spark, d).join(c, F.col("o_custkey") == F.col("c_custkey"), "left")


def usage_coverage(spark, d):
    out = usage.coverage(_attributed(spark, d), ["month"], "o_totalprice", F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("o_orderpriority").startswith("5"))
    return out.select("month", r2("total"), r2("attributed"), r2("other"), "n_attributed", "n_rows", r6("attributed_share"), r6("other_share"))


def usage_window(spark, d):
    unit = F.when(F.col("o_orderpriority").startswith("1"), "percent").otherwise("tokens")
    out = usage.window(orders(spark, d).withColumn("unit", unit), ["o_orderpriority"], "day", "1996-01-01", "1996-12-31", "o_totalprice", "unit")
    return out.withColumn("amount", F.round("amount", 2))


def curation_queue(spark, d):
    rows = _attributed(spark, d).where("day between date'1996-01-01' and date'1996-12-31'")
    return usage.queue(rows, ["c_nationkey", "c_mktsegment"], "o_totalprice", F.col("c_mktsegment") == "BUILDING", "o_orderpriority").withColumn("priority", F.round("priority", 2))


def interval_attribution(spark, d):
    c = table(spark, d, "customer").where("c_custkey % 3 <> 0")
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int"))
    one = c.select(F.col("c_custkey").alias("o_custkey"), start.alias("valid_from"), F.date_add(start, 900).alias("valid_until"), F.col("c_name").alias("target"), F.when(F.col("c_custkey") % 7 != 0, "r").alias("reviewer"), F.lit("e").alias("evidence"))
    two = one.where("o_custkey % 5 = 0").withColumns({"valid_from": F.date_add("valid_from", 400), "valid_until": F.lit(None).cast("date"), "target": F.concat("target", F.lit("/2"))})
    facts = orders(spark, d).select("o_orderkey", "o_custkey", "day")
    out = usage.in_force(facts, one.unionByName(two), "o_custkey", "day")
    return out.select("o_orderkey", F.array_join("targets", ",").alias("targets"), "state")


def january(c):
    """A day of January 2024, when the events are, by the day of the month."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.dayofmonth(c) - 1)


def same_day_join(spark, d):
    declared = events(spark, d).select("day", "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("t"))
    claims = usage.claims(declared, ["day", "user_id"], "t")
    facts = orders(spark, d).select("o_orderkey", january("day").alias("day"), F.col("o_custkey").alias("user_id"))
    joined = facts.join(claims, ["day", "user_id"], "left")
    return joined.select("o_orderkey", day_text("day"), *usage.claim_state("claimed"))


def token_funnel(spark, d):
    steps = {"urgent": F.col("o_orderpriority").startswith("1"), "matched": F.col("c_custkey").isNotNull(), "linked": F.coalesce(F.col("c_acctbal") > 0, F.lit(False))}
    out = usage.funnel(_attributed(spark, d), ["day"], "o_totalprice", steps)
    return out.select(day_text("day"), *[r2(c) for c in ("total", *steps)])


def ranked_models(spark, d):
    by = orders(spark, d).groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n_orders"))
    return by.orderBy(F.desc("total"), "o_custkey").limit(100)


def missing_days(spark, d):
    return calendar.missing(events(spark, d), "user_id", "day").withColumn("day", iso("day"))


def gap_findings(spark, d):
    known = spark.range(3).select(F.date_add(F.lit("2024-01-10").cast("date"), F.col("id").cast("int")).alias("day"), F.lit("known gap").alias("reason"))
    return calendar.findings_of_gaps(calendar.missing(events(spark, d), "user_id", "day"), known, "user_id", "day").withColumn("day", iso("day"))


def coverage_calendar(spark, d):
    rows = events(spark, d).where("not (event_type = 'error' and day < date'2024-01-05') and not (event_type = 'view' and dayofmonth(day) % 7 = 0)")
    return calendar.coverage(rows, "event_type", "day", F.col("value") < 99).withColumn("day", iso("day"))


def carry_forward(spark, d):
    rows = user_days(spark, d).select("user_id", "day", F.when(F.col("value") > 60, F.col("event_type")).alias("kind"))
    return calendar.carried(rows, "user_id", "day", "kind").withColumn("day", iso("day"))


def regressions(spark, d):
    counts = events(spark, d).groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return calendar.regressions(counts, "event_type", "day", "n", F.dayofmonth("day") % 5 != 0, 0.2, 0.2).withColumn("day", iso("day"))


def coverage_regressions(spark, d):
    asked = events(spark, d).groupBy("event_type", "day").agg(F.count("*").alias("requested"), F.nullif(F.count_if(F.col("value") > 40), F.lit(0)).alias("stored"))
    return calendar.coverage_regressions(asked, "event_type", "day", "requested", "stored").withColumn("day", iso("day"))


def staleness(spark, d):
    rows = events(spark, d).where("event_type <> 'error' or day < date'2024-01-20'")
    late = calendar.stale(rows, "event_type", "day", "2024-02-01", 2).select(F.lit("ERROR").alias("level"), F.lit("stale").alias("check"), F.concat(F.col("event_type"), F.lit(":"), F.col("lag_days")).alias("message"), day_text("last_day"))
    counts = rows.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    drops = calendar.regressions(counts, "event_type", "day", "n", F.lit(True), 0.3, 0.5).select("level", F.lit("regression").alias("check"), F.concat(F.col("event_type"), F.lit(":"), F.col("n")).alias("message"), iso("day").alias("last_day"))
    return late.unionByName(drops)


def day_completeness(spark, d):
    rows = events(spark, d).where("not (event_type = 'click' and dayofmonth(day) = 9)")
    told = calendar.completeness(rows, "day", "event_type", TYPES)
    known = spark.range(1).select(F.lit("2024-01-09").cast("date").alias("day"), F.lit("upstream outage").alias("reason"))
    level = F.when(F.col("complete"), "OK").when(F.col("reason").isNotNull(), "WARN").otherwise("ERROR")
    return told.join(F.broadcast(known), "day", "left").select(day_text("day"), "unfinished", "complete", level.alias("level"))


def null_dup_profile(spark, d):
    e = table(spark, d, "events").withColumn("value", F.when(F.col("value") > 50, F.col("value")))
    docs = table(spark, d, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("en")))
    return quality.profile(e, "events", ["event_id", "value"], ["user_id", "event_type"]).unionByName(quality.profile(docs, "documents", ["text", "lang"], ["text"]))


def profile_counts(spark, d):
    e = events(spark, d)
    total = e.agg(F.lit("all").alias("label"), F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), iso(F.min("day")).alias("first_day"), iso(F.max("day")).alias("last_day"), F.date_diff(F.max("day"), F.min("day")).alias("follow_up"))
    by = e.groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), iso(F.min("day")).alias("first_day"), iso(F.max("day")).alias("last_day"), F.date_diff(F.max("day"), F.min("day")).alias("follow_up"))
    return total.unionByName(by)


def stored_revisions(spark, d):
    """A month's dearest order is what an export of a year says that month: stored, unless the newest revision says the same."""
    o = orders(spark, d)
    year = F.date_format("day", "yyyy")
    keys = [F.concat(F.lit("n"), F.col("o_custkey") % 5).alias("source"), year.alias("start_date"), year.alias("end_date"), F.concat(F.lit("n"), F.col("o_custkey") % 5, F.lit("/u"), F.col("o_custkey") % 3).alias("url"), F.col("month").alias("fetched_at")]
    dearest = F.max_by(F.struct("o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("class")), F.struct("o_totalprice", "o_orderkey"))
    rows = o.groupBy(*keys).agg(dearest.alias("d")).withColumn("body", F.format_string('{"status":"%s","class":"%s"}', "d.o_orderstatus", "d.class")).drop("d")
    root = f"{shared_dir(spark)}/revisions-{uuid.uuid4().hex}"
    store.append(rows, root)
    read = exports.new_occurrences(exports.revisions(spark, root).where("ok"))
    return read.select("source", "start_date", "url", "fetched_at", "body", "sha256")


def group_medians(spark, d):
    """Prices of lines by return flag and by status: few groups, each with a third of all rows and as many distinct values."""
    li = table(spark, d, "lineitem")
    out = ranks.medians(li, ["l_returnflag"], "l_extendedprice", "median", few=500).withColumnRenamed("l_returnflag", "label")
    more = ranks.medians(li, ["l_linestatus"], "l_discount", "median", few=500).withColumnRenamed("l_linestatus", "label")
    return out.withColumn("of", F.lit("price")).unionByName(more.withColumn("of", F.lit("discount"))).withColumn("median", F.round("median", 6))


def bag_equality_of_copies(spark, d):
    """A table against itself in other files and another order: no row; and against itself with a few rows twice."""
    o = orders(spark, d).select("o_orderkey", "o_custkey", "o_orderpriority")
    same = quality.bag_difference(o, o.repartition(5)).withColumn("case", F.lit("same"))
    twice = quality.bag_difference(o, o.unionByName(o.where("o_orderkey % 1000 = 1"))).withColumn("case", F.lit("twice"))
    return same.unionByName(twice)


def inventory_diff(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    before = docs.where("doc_id % 11 <> 0").select("doc_id", F.sha2("text", 256).alias("sum"), F.sha2(F.upper("text"), 256).alias("other"))
    text = F.when(F.col("doc_id") % 17 == 0, F.concat("text", F.lit("!"))).when(F.col("doc_id") % 13 == 0, F.upper("text")).otherwise(F.col("text"))
    after = docs.where("doc_id % 7 <> 0").select("doc_id", F.sha2(text, 256).alias("sum"))
    return quality.inventory(before, after, "doc_id", "sum", "other")


def bag_equality(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    other = li.where("l_partkey % 97 <> 0").unionByName(li.where("l_partkey % 89 = 0"))
    return quality.bag_difference(li, other)


def violations(spark, d):
    o = orders(spark, d).withColumn("price", F.when(F.col("o_orderkey") % 501 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    o = o.withColumn("ident", F.concat(F.lit("24"), F.lpad((F.month("day") + F.when(F.col("o_orderkey") % 7 == 0, 2).otherwise(0)).cast("string"), 2, "0"), F.lit("."), F.lpad((F.col("o_orderkey") % 99998).cast("string"), 5, "0")))
    rules = {
        "non_negative": F.col("price") >= 0,
        "known_status": F.col("o_orderstatus").isin("O", "F", "P"),
        "not_in_future": F.col("day") <= F.lit("2001-07-01").cast("date"),
        "paper_id": valid_paper_id(F.col("ident")),
    }
    return quality.violations(o, "o_orderkey", rules)


def hosting_day(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("day"), F.when(F.col("l_quantity") > 5, F.col("l_suppkey")).alias("provider"), F.when(F.col("l_linestatus") == "O", "live").otherwise(F.nullif("l_returnflag", F.lit("A"))).alias("status"), "l_orderkey", "l_linenumber")
    out = marts.hosting(li, "l_partkey", "day", "provider", "status", [F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long")])
    return out.withColumn("day", iso("day"))


def nested_cards(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    out = marts.cards(c, orders(spark, d).select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey", ["o_orderkey", "o_orderstatus"], "o_orderkey")
    return out.select("o_custkey", "c_name", "n_items", F.to_json(F.transform("items", lambda x: x["o_orderkey"])).alias("items"))


def _told(spark, d):
    members = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    months = F.transform(F.sequence(F.lit("1996-01-01").cast("date"), F.lit("1996-12-01").cast("date"), F.expr("interval 1 month")), lambda x: F.date_format(x, "yyyy-MM"))
    seen = orders(spark, d).where("o_orderstatus <> 'F'")
    failed = orders(spark, d).where("o_orderstatus = 'F'").groupBy("o_custkey", "month").agg(F.min("o_orderpriority").alias("reason"))
    return marts.outcomes(members, months, seen, failed, "o_custkey", "month")


def member_outcomes(spark, d):
    return marts.outcome_coverage(_told(spark, d), "month")


def before_after(spark, d):
    count = lambda y: orders(spark, d).where(F.year("day") == y).groupBy("o_custkey").agg(F.count("*").alias("n"))
    rich = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("rich"))
    return marts.changes(count(1996), count(1997), "o_custkey", "n").join(rich, "o_custkey", "left").withColumn("rich", F.coalesce("rich", F.lit(False)))


def sample_profile(spark, d):
    return marts.sample_profile(table(spark, d, "part"), "p_brand", "p_retailprice", F.col("p_size") > 10)


QUERIES = {f.__name__: f for f in (
    usage_shares, share_denominators, usage_coverage, usage_window, curation_queue, interval_attribution, same_day_join, token_funnel, ranked_models, missing_days, gap_findings,
    coverage_calendar, carry_forward, regressions, coverage_regressions, staleness, day_completeness, null_dup_profile, profile_counts, stored_revisions, group_medians, bag_equality_of_copies, inventory_diff, bag_equality, violations, hosting_day, nested_cards,
    member_outcomes, before_after, sample_profile,
)}

_O = "WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, o_orderdate::DATE AS day FROM orders)"
_OC = f"{_O}, a AS (SELECT * FROM o LEFT JOIN customer ON o_custkey = c_custkey)"
_S = f"""{_O}, s AS (SELECT month, o_orderpriority, sum(o_totalprice) AS amount FROM o GROUP BY ALL), t AS (SELECT *, sum(amount) OVER (PARTITION BY month) AS total FROM s)"""
_MISS = f"""{EVENTS_SQL}, b AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM e GROUP BY user_id), m AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = b.user_id AND e.day = b.day))"""
_REG = "SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS previous FROM c"

ORACLES = {
    "usage_shares": f"{_S} SELECT month, o_orderpriority, round(amount, 2) AS amount, round(total, 2) AS total, round(100 * amount / total, 6) AS share_percent FROM t",
    "share_denominators": f"""{_S}, p AS (SELECT month, 100 * amount / total - CASE WHEN month LIKE '%-06' AND o_orderpriority LIKE '1%' THEN 120 ELSE 0 END AS share FROM t)
        SELECT month, round(sum(share), 4) AS sum_percent, count_if(share < 0 OR share > 100) AS n_outside FROM p GROUP BY month HAVING abs(sum(share) - 100) > 0.05 OR count_if(share < 0 OR share > 100) > 0""",
    "usage_coverage": f"""{_OC}, g AS (SELECT month, sum(o_totalprice) AS total, coalesce(sum(o_totalprice) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')), 0) AS attributed, coalesce(sum(o_totalprice) FILTER (o_orderpriority LIKE '5%'), 0) AS other,
        count_if(c_mktsegment IN ('BUILDING', 'MACHINERY')) AS n_attributed, count(*) AS n_rows FROM a GROUP BY month)
        SELECT month, round(total, 2) AS total, round(attributed, 2) AS attributed, round(other, 2) AS other, n_attributed, n_rows, round(attributed / total, 6) AS attributed_share, round(other / total, 6) AS other_share FROM g""",
    "usage_window": f"""{_O} SELECT o_orderpriority, CASE WHEN o_orderpriority LIKE '1%' THEN 'percent' ELSE 'tokens' END AS unit, count(DISTINCT day) AS n_days, count(*) AS n_rows,
        round(CASE WHEN o_orderpriority LIKE '1%' THEN sum(o_totalprice) / count(DISTINCT day) ELSE sum(o_totalprice) END, 2) AS amount FROM o WHERE day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' GROUP BY o_orderpriority""",
    "curation_queue": f"""{_OC} SELECT c_nationkey, c_mktsegment, round(sum(o_totalprice), 2) AS priority, count(*) AS n_rows, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS evidence
        FROM a WHERE day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND NOT (c_mktsegment = 'BUILDING') GROUP BY 1, 2""",
    "interval_attribution": f"""{_O}, l AS (SELECT c_custkey, DATE '1995-01-01' + (c_custkey % 700)::INT AS f, DATE '1995-01-01' + (c_custkey % 700)::INT + 900 AS u, c_name AS t FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 7 <> 0),
        m AS (SELECT * FROM l UNION ALL SELECT c_custkey, f + 400, NULL, t || '/2' FROM l WHERE c_custkey % 5 = 0)
        SELECT o_orderkey, coalesce(string_agg(DISTINCT t, ',' ORDER BY t), '') AS targets, CASE count(DISTINCT t) WHEN 0 THEN 'unresolved' WHEN 1 THEN 'curated' ELSE 'ambiguous' END AS state
        FROM o LEFT JOIN m ON c_custkey = o_custkey AND day >= f AND day <= coalesce(u, day) GROUP BY o_orderkey""",
    "same_day_join": f"""{EVENTS_SQL}, c AS (SELECT day, user_id, list(DISTINCT CASE WHEN event_type <> 'view' THEN event_type ELSE '' END) AS s FROM e GROUP BY 1, 2),
        f AS (SELECT o_orderkey, DATE '2024-01-01' + day(o_orderdate)::INT - 1 AS day, o_custkey AS user_id FROM orders), j AS (SELECT f.*, s, list_filter(coalesce(s, []), lambda x: x <> '') AS v FROM f LEFT JOIN c USING (day, user_id))
        SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS day, CASE WHEN len(v) = 0 THEN 'unresolved' WHEN len(v) = 1 AND len(s) = 1 THEN 'source_explicit' ELSE 'ambiguous' END AS state, CASE WHEN len(v) = 1 AND len(s) = 1 THEN v[1] END AS target FROM j""",
    "token_funnel": f"""{_OC} SELECT strftime(day, '%Y-%m-%d') AS day, round(sum(o_totalprice), 2) AS total, round(sum(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice ELSE 0 END), 2) AS urgent,
        round(sum(CASE WHEN c_custkey IS NOT NULL THEN o_totalprice ELSE 0 END), 2) AS matched, round(sum(CASE WHEN c_acctbal > 0 THEN o_totalprice ELSE 0 END), 2) AS linked FROM a GROUP BY a.day""",
    "ranked_models": "SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS n_orders FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100",
    "missing_days": f"{_MISS} SELECT user_id, strftime(day, '%Y-%m-%d') AS day FROM m",
    "gap_findings": f"{_MISS} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CASE WHEN m.day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 'WARN' ELSE 'ERROR' END AS level, CASE WHEN m.day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 'known gap' ELSE 'no snapshot' END AS message FROM m",
    "coverage_calendar": f"""{EVENTS_SQL}, r AS (SELECT * FROM e WHERE NOT (event_type = 'error' AND day < DATE '2024-01-05') AND NOT (event_type = 'view' AND day(e.day) % 7 = 0)),
        s AS (SELECT event_type, day, bool_and(value < 99) AS ok, count(*) AS n FROM r GROUP BY ALL), b AS (SELECT event_type, min(day) AS start FROM r GROUP BY 1), k AS (SELECT unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM r)
        SELECT b.event_type, strftime(k.day, '%Y-%m-%d') AS day, CASE WHEN k.day < start THEN 'not_started' WHEN ok IS NULL THEN 'missing' WHEN ok THEN 'ok' ELSE 'partial' END AS status, coalesce(n, 0) AS n_rows
        FROM b CROSS JOIN k LEFT JOIN s ON s.event_type = b.event_type AND s.day = k.day""",
    "carry_forward": f"""{EVENTS_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rank, ts, event_id) AS n FROM e), k AS (SELECT user_id, day, CASE WHEN value > 60 THEN event_type END AS kind FROM c WHERE n = 1)
        SELECT user_id, strftime(day, '%Y-%m-%d') AS day, kind, last_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried_kind FROM k""",
    "regressions": f"""{EVENTS_SQL}, c AS (SELECT event_type, day, count(*) AS n FROM e WHERE day(e.day) % 5 <> 0 GROUP BY ALL), l AS ({_REG})
        SELECT event_type, strftime(day, '%Y-%m-%d') AS day, previous, n, round(1 - n / previous, 6) AS drop, CASE WHEN round(1 - n / previous, 6) >= 0.2 THEN 'ERROR' ELSE 'WARN' END AS level FROM l WHERE round(1 - n / previous, 6) >= 0.2""",
    "coverage_regressions": f"""{EVENTS_SQL}, c AS (SELECT event_type, day, count(*) AS requested, nullif(count_if(value > 40), 0) AS stored FROM e GROUP BY ALL), v AS (SELECT *, stored / requested AS ratio FROM c WHERE stored IS NOT NULL),
        l AS (SELECT *, round(lag(ratio) OVER w - ratio, 9) AS drop, lag(requested) OVER w AS before FROM v WINDOW w AS (PARTITION BY event_type ORDER BY day))
        SELECT event_type, strftime(day, '%Y-%m-%d') AS day, 'coverage' AS "check", CASE WHEN drop >= 0.2 THEN 'ERROR' ELSE 'WARN' END AS level, requested, stored, round(drop, 6) AS drop FROM l WHERE drop >= 0.05
        UNION ALL SELECT event_type, strftime(day, '%Y-%m-%d'), 'catalogue', 'WARN', requested, stored, round(drop, 6) FROM l WHERE requested < before * 0.8""",
    "staleness": f"""{EVENTS_SQL}, r AS (SELECT * FROM e WHERE event_type <> 'error' OR day < DATE '2024-01-20'), s AS (SELECT event_type, max(day) AS last, date_diff('day', max(day), DATE '2024-02-01') AS late FROM r GROUP BY 1),
        c AS (SELECT event_type, day, count(*) AS n FROM r GROUP BY ALL), l AS ({_REG})
        SELECT 'ERROR' AS level, 'stale' AS "check", event_type || ':' || late AS message, strftime(last, '%Y-%m-%d') AS last_day FROM s WHERE late > 2
        UNION ALL SELECT CASE WHEN round(1 - n / previous, 6) >= 0.5 THEN 'ERROR' ELSE 'WARN' END, 'regression', event_type || ':' || n, strftime(day, '%Y-%m-%d') FROM l WHERE round(1 - n / previous, 6) >= 0.3""",
    "day_completeness": f"""{EVENTS_SQL}, r AS (SELECT * FROM e WHERE NOT (event_type = 'click' AND day(e.day) = 9)), s AS (SELECT day, list(DISTINCT event_type) AS seen FROM r GROUP BY 1),
        u AS (SELECT day, list_sort(list_filter(['purchase', 'signup', 'error', 'click', 'view'], lambda x: NOT list_contains(seen, x))) AS missing FROM s)
        SELECT strftime(day, '%Y-%m-%d') AS day, array_to_string(missing, ',') AS unfinished, len(missing) = 0 AS complete, CASE WHEN len(missing) = 0 THEN 'OK' WHEN u.day = DATE '2024-01-09' THEN 'WARN' ELSE 'ERROR' END AS level FROM u""",
    "null_dup_profile": """WITH x AS (SELECT (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)) AS ev, (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM documents GROUP BY text)) AS dc)
        SELECT 'events' AS table_name, 'event_id' AS column_name, count(*) AS n_rows, round(avg((event_id IS NULL)::INT), 6) AS null_rate, any_value(ev) AS n_excess FROM events, x UNION ALL
        SELECT 'events', 'value', count(*), round(avg((NOT value > 50)::INT), 6), any_value(ev) FROM events, x UNION ALL
        SELECT 'documents', 'text', count(*), round(avg((text IS NULL)::INT), 6), any_value(dc) FROM documents, x UNION ALL
        SELECT 'documents', 'lang', count(*), round(avg((nullif(lang, 'en') IS NULL)::INT), 6), any_value(dc) FROM documents, x""",
    "profile_counts": f"""{EVENTS_SQL}, l AS (SELECT 'all' AS label, * FROM e UNION ALL SELECT event_type, * FROM e)
        SELECT label, count(*) AS n, count(DISTINCT user_id) AS n_users, strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day, date_diff('day', min(day), max(day))::INT AS follow_up FROM l GROUP BY label""",
    "group_medians": """SELECT l_returnflag AS label, 'price' AS "of", round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY 1 UNION ALL SELECT l_linestatus, 'discount', round(median(l_discount), 6) FROM lineitem GROUP BY 1""",
    "bag_equality_of_copies": "SELECT o_orderkey, o_custkey, o_orderpriority, 'right' AS side, 'twice' AS \"case\" FROM orders WHERE o_orderkey % 1000 = 1",
    "stored_revisions": f"""{_O}, r AS (SELECT 'n' || (o_custkey % 5) AS source, strftime(day, '%Y') AS start_date, 'n' || (o_custkey % 5) || '/u' || (o_custkey % 3) AS url, month AS fetched_at, arg_max('{{"status":"' || o_orderstatus || '","class":"' || o_orderpriority[1] || '"}}', {{'p': o_totalprice, 'k': o_orderkey}}) AS body FROM o GROUP BY ALL),
        p AS (SELECT *, lag(body) OVER (PARTITION BY source, start_date, url ORDER BY fetched_at) AS b FROM r) SELECT source, start_date, url, fetched_at, body, sha256(body) AS sha256 FROM p WHERE body IS DISTINCT FROM b""",
    "inventory_diff": """WITH b AS (SELECT doc_id, sha256(text) AS s, sha256(upper(text)) AS u FROM documents WHERE doc_id % 11 <> 0),
        a AS (SELECT doc_id, sha256(CASE WHEN doc_id % 17 = 0 THEN text || '!' WHEN doc_id % 13 = 0 THEN upper(text) ELSE text END) AS s FROM documents WHERE doc_id % 7 <> 0),
        j AS (SELECT coalesce(b.doc_id, a.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'missing' WHEN b.doc_id IS NULL THEN 'added' WHEN b.s = a.s THEN 'same' WHEN b.u = a.s THEN 'alternate' ELSE 'changed' END AS state FROM b FULL JOIN a ON a.doc_id = b.doc_id)
        SELECT * FROM j WHERE state <> 'same'""",
    "bag_equality": """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem), b AS (SELECT * FROM a WHERE l_partkey % 97 <> 0 UNION ALL SELECT * FROM a WHERE l_partkey % 89 = 0)
        SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "violations": f"""{_O}, v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 501 = 0 THEN -o_totalprice ELSE o_totalprice END AS price, o_orderstatus, day, '24' || lpad((month(day) + CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 0 END)::VARCHAR, 2, '0') || '.' || lpad((o_orderkey % 99998)::VARCHAR, 5, '0') AS id FROM o)
        SELECT o_orderkey, 'non_negative' AS rule FROM v WHERE NOT price >= 0 UNION ALL SELECT o_orderkey, 'known_status' FROM v WHERE o_orderstatus NOT IN ('O', 'F', 'P')
        UNION ALL SELECT o_orderkey, 'not_in_future' FROM v WHERE day > DATE '2001-07-01'
        UNION ALL SELECT o_orderkey, 'paper_id' FROM v WHERE NOT (regexp_full_match(id, '\\d{{4}}\\.\\d{{4,5}}') AND id[3:4]::INT BETWEEN 1 AND 12 AND regexp_extract(id, '\\.(\\d+)', 1)::INT > 0 AND (id[1:2]::INT > 7 OR id[1:2]::INT = 7 AND id[3:4]::INT >= 4))""",
    "hosting_day": """WITH l AS (SELECT l_partkey, l_shipdate::DATE AS day, CASE WHEN l_quantity > 5 THEN l_suppkey END AS p, CASE WHEN l_linestatus = 'O' THEN 'live' ELSE nullif(l_returnflag, 'A') END AS st, '[' || l_orderkey || ',' || l_linenumber || ']' AS at_, l_orderkey, l_linenumber FROM lineitem),
        s AS (SELECT l_partkey, day, coalesce(st, 'unknown') AS st, count(*) AS n FROM l WHERE p IS NOT NULL GROUP BY ALL), m AS (SELECT l_partkey, day, string_agg(st || '=' || n, ',' ORDER BY st || '=' || n) AS statuses FROM s GROUP BY ALL),
        u AS (SELECT DISTINCT l_partkey, day, at_, l_orderkey, l_linenumber FROM l), w AS (SELECT l_partkey, day, '[' || string_agg(at_, ',' ORDER BY l_orderkey, l_linenumber) || ']' AS row_locators FROM u GROUP BY ALL),
        q AS (SELECT l_partkey, day, count(DISTINCT p) AS n_declared, count(DISTINCT CASE WHEN st = 'live' THEN p END) AS n_live, list_sort(list(DISTINCT p) FILTER (st = 'live' AND p IS NOT NULL)) AS lp FROM l GROUP BY ALL)
        SELECT l_partkey, strftime(q.day, '%Y-%m-%d') AS day, n_declared, n_live, coalesce(array_to_string(lp, ','), '') AS live_providers, coalesce(statuses, '') AS statuses, CASE WHEN n_declared > 0 THEN 'declared' ELSE 'unknown' END AS state, row_locators
        FROM q JOIN w USING (l_partkey, day) LEFT JOIN m USING (l_partkey, day)""",
    "nested_cards": "SELECT c_custkey AS o_custkey, c_name, count(o_orderkey) AS n_items, coalesce('[' || string_agg(o_orderkey, ',' ORDER BY o_orderkey) || ']', '[]') AS items FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name",
    "member_outcomes": f"""{_O}, g AS (SELECT c_custkey AS k, month FROM customer CROSS JOIN (SELECT DISTINCT month FROM o WHERE year(day) = 1996)),
        t AS (SELECT g.k, g.month, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o_custkey = g.k AND o.month = g.month AND o_orderstatus <> 'F') THEN 'observed'
          ELSE coalesce((SELECT min(o_orderpriority) FROM o WHERE o_custkey = g.k AND o.month = g.month AND o_orderstatus = 'F'), 'unobserved') END AS outcome FROM g),
        b AS (SELECT month, outcome, count(*) AS n FROM t GROUP BY ALL)
        SELECT month, sum(n)::BIGINT AS n_members, coalesce(sum(n) FILTER (outcome = 'observed'), 0)::BIGINT AS n_observed, coalesce(string_agg(outcome || '=' || n, ',' ORDER BY outcome || '=' || n) FILTER (outcome <> 'observed'), '') AS reasons,
        round(coalesce(sum(n) FILTER (outcome = 'observed'), 0) / sum(n), 6) AS coverage FROM b GROUP BY month""",
    "before_after": f"""{_O}, x AS (SELECT o_custkey, count(*) AS n FROM o WHERE year(day) = 1996 GROUP BY 1), y AS (SELECT o_custkey, count(*) AS n FROM o WHERE year(day) = 1997 GROUP BY 1)
        SELECT o_custkey, x.n AS before, y.n AS after, y.n - x.n AS change, coalesce(c_acctbal > 5000, false) AS rich FROM x JOIN y USING (o_custkey) LEFT JOIN customer ON c_custkey = o_custkey""",
    "sample_profile": "SELECT p_brand, count(*) AS n_rows, round(min(p_retailprice), 6) AS least, round(median(p_retailprice), 6) AS median, round(max(p_retailprice), 6) AS most, count_if(p_size > 10) AS n_populated FROM part GROUP BY 1",
}
