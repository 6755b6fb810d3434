"""Queries of beliefs, changes, trajectories, samples and scalar functions, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import identity, sampling, temporal, trajectories
from ..operators.lifecycle import iso_week
from .binding import EVENTS_SQL, TYPES, day_text, events, iso, table, user_days


def r6(c):
    return F.round(c, 6).alias(c)


def _states(spark, d):
    return temporal.validity(events(spark, d).select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], "event_type")


def text_of(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def scd2_intervals(spark, d):
    return _states(spark, d).select("user_id", "event_id", "event_type", text_of("valid_from"), text_of("valid_to"))


def _belief(spark, d):
    e = events(spark, d).withColumn("target", F.concat(F.lit("t"), F.floor(F.col("value") / 34)))
    return temporal.belief(e, "user_id", "day", "event_type", "target", TYPES)


def priority_belief(spark, d):
    return _belief(spark, d).withColumn("day", iso("day")).withColumn("targets", F.array_join("targets", ","))


def belief_events(spark, d):
    return identity.belief_events(_belief(spark, d), "user_id", "day").withColumn("day", iso("day")).withColumn("wavering", F.array_join("wavering", ","))


def asof_lookup(spark, d):
    probes = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.dayofmonth("o_orderdate"), F.lit(12), F.lit(0), F.lit(0)).alias("at"))
    return temporal.as_of(probes, _states(spark, d), "user_id", "at", ["event_id", "event_type"]).select("o_orderkey", "event_id", "event_type")


def hot_key_scan(spark, d):
    """Few keys with many rows each, scanned in pieces: the last large purchase known at each event of its type."""
    e = events(spark, d).select("event_type", "ts", "event_id", F.when(F.col("value") > 90, F.col("event_id")).alias("large"))
    return temporal.last_known(e, "event_type", ["ts", "event_id"], ["large"], most=500).select("event_id", "event_type", "large")


def hot_key_asof(spark, d):
    """Orders of a priority meet the state of the events of one type: a key has a fifth of all rows on both sides."""
    states = temporal.validity(events(spark, d).select("event_type", "ts", "event_id", F.floor(F.col("value") / 34).alias("level")), "event_type", ["ts", "event_id"], "level", most=500)
    kind = F.element_at(F.array(*[F.lit(t) for t in TYPES]), F.substring("o_orderpriority", 1, 1).cast("int"))
    probes = table(spark, d, "orders").select("o_orderkey", kind.alias("event_type"), F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.dayofmonth("o_orderdate"), F.hour(F.timestamp_seconds("o_orderkey")), F.lit(0), F.lit(0)).alias("at"))
    return temporal.as_of(probes, states, "event_type", "at", ["event_id", "level"], most=500).select("o_orderkey", "event_id", "level")


def open_segments(spark, d):
    """Reviews of a customer, from an order's day for some days; where they overlap the segments have several targets."""
    day = F.to_date("o_orderdate")
    days = (F.col("o_orderkey") % 200).cast("int")
    rows = table(spark, d, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).alias("target"), day.alias("since"), F.when(F.col("o_orderkey") % 11 != 0, F.date_add(day, days - 5)).alias("until"))
    out = temporal.open_sets(rows, "o_custkey", "target", "since", "until")
    return out.select("o_custkey", day_text("valid_from"), day_text("valid_to"), F.array_join("targets", ",").alias("targets"))


def _values(spark, d):
    return user_days(spark, d).select("user_id", "day", F.when(F.col("value") > 10, F.col("value")).alias("value"))


def interval_changes(spark, d):
    rows = user_days(spark, d).select("user_id", "day", F.when(F.col("value") > 10, F.col("value")).alias("value"), F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("at"))
    out = trajectories.interval_changes(rows, "user_id", "day", "value", "at")
    return out.select("user_id", day_text("previous_day"), day_text("day"), r6("elapsed_days"), r6("change"), r6("change_per_day"), r6("relative_change"), "basis")


def trajectory_features(spark, d):
    out = trajectories.features(_values(spark, d), "user_id", "day", "value")
    return out.select("user_id", day_text("first_day"), day_text("last_day"), "n_days", "max_gap", "n_values", r6("first_value"), r6("last_value"), "span_days", r6("coverage"), r6("relative_change"))


def shape_features(spark, d):
    out = trajectories.shapes(_values(spark, d), "user_id", "day", "value")
    return out.select("user_id", r6("peak"), day_text("peak_day"), r6("total_variation"), r6("volatility"), "reversals", "n_blocks", r6("up_share"), r6("down_share"), r6("peak_rise"), r6("peak_fall"), "interior_peak")


def _both(spark, d):
    return trajectory_features(spark, d).join(shape_features(spark, d), "user_id")


def screens(spark, d):
    sets = spark.range(3).select(F.element_at(F.array(F.lit("low"), F.lit("middle"), F.lit("high")), (F.col("id") + 1).cast("int")).alias("name"), (F.col("id") * 0.5).alias("least"))
    rules = {"grew": F.col("relative_change") > F.col("least"), "volatile": F.col("volatility") > F.col("least"), "turning": F.col("reversals") > 10 * F.col("least")}
    return trajectories.screens(_both(spark, d), sets, rules)


def case_pick(spark, d):
    out = trajectories.pick(_both(spark, d), "user_id", {"growth": (F.col("relative_change").isNotNull(), "relative_change"), "volatility": (F.col("volatility").isNotNull(), "volatility"), "variation": (F.col("n_days") > 5, "total_variation")})
    return out.withColumn("score", F.round(F.col("score").cast("double"), 6))


def cohort_sample(spark, d):
    c = sampling.distinct_candidates(table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), "c_custkey")
    c = c.withColumn("recent", F.when(F.col("c_custkey") % 40 == 0, F.col("c_custkey")))
    return sampling.members(c, "c_custkey", "c_acctbal", "recent", "c_nationkey", 300, "s1")


def worklist(spark, d):
    done = table(spark, d, "orders").where("o_orderdate >= timestamp'2000-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return sampling.work_list(table(spark, d, "customer"), done, "c_custkey")


def seeded_digest(spark, d):
    pop = sampling.population(table(spark, d, "customer"), "c_nationkey", "c_custkey")
    keys = table(spark, d, "customer").groupBy("c_nationkey").agg(F.min(scalars.content_key(F.col("c_name"), F.col("c_mktsegment"))).alias("least_key"))
    return pop.join(keys, "c_nationkey")


def iso_parse(spark, d):
    """Days as text with and without offset, as bare digits, and as epochs; and what is neither."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k % 5 == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit("soon")).when(k % 13 == 0, F.concat(day, F.lit("T10:20:30+02:00"))).when(k % 17 == 0, F.date_format("o_orderdate", "yyyy")).otherwise(F.concat(day, F.lit("T01:02:03Z")))
    value = F.when(k % 19 == 0, F.to_variant_object(F.array(F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))))).otherwise(F.to_variant_object(F.array(text)))
    item = F.variant_get(value, "$[0]", "variant")
    at = scalars.instant_of(item)
    return table(spark, d, "orders").select("o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"), scalars.bad_instant(item, at).alias("bad"), scalars.strict_instant(text).isNotNull().alias("strict"))


def id_regex(spark, d):
    """Modern and old ids, with prefixes, versions and flaws."""
    k = F.col("doc_id")
    modern = F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lpad((k % 14).cast("string"), 2, "0"), F.lit("."), F.lpad((F.col("n_chars") % 3000).cast("string"), F.when(k % 2 == 0, 4).otherwise(5), F.lit("0")))
    old = F.concat(F.when(k % 4 == 0, "hep-th/").when(k % 4 == 1, "math.AG/").otherwise("Q-BIO/"), F.lpad((k % 9).cast("string"), 7, "0"))
    raw = F.concat(F.when(k % 2 == 0, "arXiv:").when(k % 7 == 1, "ARXIV:").otherwise(" "), F.when(k % 5 == 0, old).otherwise(modern), F.when(k % 3 == 0, "v2").when(k % 3 == 1, "V11").otherwise(""), F.when(k % 11 == 0, "x").otherwise(" "))
    out = table(spark, d, "documents").select("doc_id", scalars.paper_id(raw).alias("paper"))
    return out.select("doc_id", "paper", scalars.valid_paper_id(F.col("paper")).alias("valid"))


def json_props(spark, d):
    p = F.from_json("props", "k long")
    return table(spark, d, "events").select("event_id", p["k"].alias("k"), p["k"].isNull().alias("bad"))


def tag_lists(spark, d):
    tags = F.array(F.concat(F.lit("arxiv:2301."), F.lpad((F.col("p_partkey") % 7 + 1).cast("string"), 5, "0")), F.concat(F.lit("base_model:finetune:"), F.col("p_brand")), F.concat(F.when(F.col("p_size") > 30, "base_model:quantized:").otherwise("base_model:"), F.col("p_type")), F.when(F.col("p_size") > 20, "ARXIV:2301.00003v2"), F.when(F.col("p_size") > 40, "arxiv:hep-th/9901001V3"))
    tags = F.array_compact(tags)
    return table(spark, d, "part").select("p_partkey", F.array_join(scalars.paper_ids(tags), ",").alias("papers"), scalars.base_model(tags).alias("base"))


def url_parts(spark, d):
    """The pages' paths, under their own host and under hosts and sections of repositories."""
    k, own = F.col("page_id"), F.regexp_extract("url", r"^[a-z]+://[^/?#]+(.*)$", 1)
    url = F.when(k % 6 == 0, F.concat(F.lit("https://huggingface.co"), own)).when(k % 6 == 1, F.concat(F.lit("https://u@WWW.HuggingFace.co:443/"), own)).when(k % 6 == 2, F.concat(F.lit("https://huggingface.co/datasets"), own)).when(k % 6 == 3, F.concat(F.lit("https://huggingface.co.example.com"), own)).when(k % 6 == 4, F.concat(F.lit("http://huggingface.co/papers%2F"), own)).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", F.lower(F.try_parse_url(url, F.lit("HOST"))).alias("host"), scalars.repo_of(url).alias("repo"))


def share_long(spark, d):
    long = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("position", "share"))
    return long.groupBy("label", "position").agg(F.count("*").alias("n"), F.round(F.sum(F.col("share").cast("double")), 3).alias("total"))


def scalar_dates(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", iso_week(day).alias("week"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.date_diff(F.lit("2001-12-31").cast("date"), day).alias("age"), iso(F.date_add(day, 30)).alias("milestone"), F.size(F.sequence(F.trunc(day, "month"), day, F.expr("interval 1 day"))).alias("spine"), scalars.precision(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("precision"))


def scalar_labels(spark, d):
    c = table(spark, d, "customer")
    label = F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") < 5000, "low").otherwise("high")
    return c.select("c_custkey", label.alias("label"), F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.split_part("c_name", F.lit("#"), F.lit(1))).alias("author"), scalars.primary(F.col("c_mktsegment"), (F.col("c_custkey") % 9).cast("int"), "BUILDING").alias("is_primary"), F.when(F.col("c_acctbal") > 0, F.round((10000 - F.col("c_acctbal")) / F.col("c_acctbal"), 6)).alias("relative"))


def price_normalise(spark, d):
    """Prices of the parts, written in several ways: equal ones must be told whatever their exponent."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    cents = F.round(F.col("p_retailprice") * 100).cast("long").cast("string")
    raw = (
        F.when(k % 8 == 0, F.concat(size, F.lit(".10"))).when(k % 8 == 1, F.concat(F.lit("00"), size, F.lit(".1"))).when(k % 8 == 2, F.concat(size, F.lit("1e-1"))).when(k % 8 == 3, F.concat(F.lit("-"), cents, F.lit("E-2")))
        .when(k % 8 == 4, F.lit("-0.00")).when(k % 8 == 5, F.concat(size, F.lit("e-30"))).when(k % 8 == 6, F.concat(F.lit("+"), cents, F.lit(".0e50"))).otherwise(F.lit("free"))
    )
    other = F.when(k % 8 == 5, F.concat(F.lit("0."), F.repeat(F.lit("0"), 30 - F.length(size)), size, F.lit("0"))).when(k % 8 == 6, F.concat(cents, F.repeat(F.lit("0"), F.lit(50)))).otherwise(F.concat(size, F.lit(".1")))
    a, b = F.create_map(F.lit("prompt"), raw, F.lit("unit"), F.lit("token")), F.create_map(F.lit("prompt"), other, F.lit("unit"), F.when(k % 4 == 0, "token").otherwise(F.col("p_brand")))
    priced = table(spark, d, "part").select("p_partkey", scalars.price(raw).alias("a"), scalars.price(other).alias("b"), scalars.changed_keys(a, b).alias("changed"))
    return priced.select("p_partkey", F.col("a.kind").alias("kind"), F.col("a.value").alias("number"), F.col("a").eqNullSafe(F.col("b")).alias("same"), F.array_join("changed", ",").alias("changed"))


QUERIES = {f.__name__: f for f in (
    scd2_intervals, priority_belief, belief_events, asof_lookup, hot_key_scan, hot_key_asof, open_segments, interval_changes, trajectory_features, shape_features, screens, case_pick,
    cohort_sample, worklist, seeded_digest, iso_parse, id_regex, json_props, tag_lists, url_parts, share_long, scalar_dates, scalar_labels, price_normalise,
)}

_SCD = f"""{EVENTS_SQL}, l AS (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, event_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM l WHERE n = 1 OR p IS DISTINCT FROM event_type)"""
_M = ["purchase", "signup", "error", "click", "view"]
_LAST = ", ".join(f"last_value(m_{m} IGNORE NULLS) OVER w AS m_{m}" for m in _M)
_ANY = f"coalesce({', '.join(f'm_{m}' for m in _M)})"
_BEL = f"""{EVENTS_SQL}, i AS (SELECT user_id, day, {', '.join(f"list_sort(list(DISTINCT 't' || floor(value / 34)::INT) FILTER (event_type = '{m}')) AS m_{m}" for m in _M)} FROM e GROUP BY ALL),
h AS (SELECT user_id, day, {_LAST} FROM i WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT user_id, day, CASE {' '.join(f"WHEN m_{m} IS NOT NULL THEN '{m}'" for m in _M)} END AS method, CASE WHEN len({_ANY}) = 1 THEN {_ANY}[1] END AS target, CASE WHEN len({_ANY}) = 1 THEN 'resolved' ELSE 'ambiguous' END AS state, array_to_string({_ANY}, ',') AS targets FROM h)"""
_VAL = f"""{EVENTS_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rank, ts, event_id) AS n FROM e), v AS (SELECT user_id, day, CASE WHEN value > 10 THEN value END AS value FROM c WHERE n = 1)"""
_FEAT = f"""{_VAL}, g AS (SELECT *, date_diff('day', lag(v.day) OVER (PARTITION BY user_id ORDER BY v.day), v.day) AS gap FROM v),
f AS (SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days, coalesce(max(gap), 0)::INT AS max_gap, count(value) AS n_values, arg_min(value, day) FILTER (value IS NOT NULL) AS first_value, arg_max(value, day) FILTER (value IS NOT NULL) AS last_value FROM g GROUP BY user_id),
ft AS (SELECT user_id, strftime(first_day, '%Y-%m-%d') AS first_day, strftime(last_day, '%Y-%m-%d') AS last_day, n_days, max_gap, n_values, round(first_value, 6) AS first_value, round(last_value, 6) AS last_value, date_diff('day', f.first_day, f.last_day)::INT AS span_days,
  round(n_days / (date_diff('day', f.first_day, f.last_day) + 1), 6) AS coverage, round(CASE WHEN f.first_value > 0 THEN (f.last_value - f.first_value) / f.first_value END, 6) AS relative_change FROM f)"""
_SHAPE = f"""{_FEAT}, k AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS start, value - lag(value) OVER (PARTITION BY user_id ORDER BY day) AS dv FROM v),
mv AS (SELECT user_id, sign(dv) * sign(lag(dv) OVER (PARTITION BY user_id ORDER BY day)) < 0 AS turn FROM k WHERE dv <> 0), tn AS (SELECT user_id, count_if(turn) AS reversals FROM mv GROUP BY 1),
bs AS (SELECT user_id, max(value) AS peak, first(day ORDER BY value DESC, day) FILTER (value IS NOT NULL) AS peak_day, coalesce(sum(abs(dv)), 0) AS total_variation, stddev_pop(dv) / greatest(avg(value), 1.0) AS volatility, arg_min(value, day) FILTER (value IS NOT NULL) AS fv, arg_max(value, day) FILTER (value IS NOT NULL) AS lv,
  min(day) FILTER (value IS NOT NULL) AS fd, max(day) FILTER (value IS NOT NULL) AS ld FROM k GROUP BY 1),
bl AS (SELECT user_id, floor(date_diff('day', start, day) / 7) AS block, median(value) AS m FROM k WHERE value IS NOT NULL GROUP BY ALL HAVING count(*) >= 4), bd AS (SELECT user_id, m - lag(m) OVER (PARTITION BY user_id ORDER BY block) AS c FROM bl),
de AS (SELECT user_id, count(*) AS n_blocks, count_if(c > 0) / nullif(count(c), 0) AS up_share, count_if(c < 0) / nullif(count(c), 0) AS down_share FROM bd GROUP BY 1),
sh AS (SELECT bs.user_id, round(peak, 6) AS peak, strftime(peak_day, '%Y-%m-%d') AS peak_day, round(total_variation, 6) AS total_variation, round(volatility, 6) AS volatility, coalesce(reversals, 0) AS reversals, coalesce(n_blocks, 0) AS n_blocks, round(coalesce(up_share, 0), 6) AS up_share, round(coalesce(down_share, 0), 6) AS down_share,
  round(coalesce(peak - fv, 0), 6) AS peak_rise, round(coalesce(peak - lv, 0), 6) AS peak_fall, coalesce(fd < peak_day AND peak_day < ld, false) AS interior_peak
  FROM bs LEFT JOIN tn USING (user_id) LEFT JOIN de USING (user_id)), fs AS (SELECT * FROM ft JOIN sh USING (user_id))"""

ORACLES = {
    "scd2_intervals": f"{_SCD} SELECT user_id, event_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to FROM s",
    "priority_belief": f"{_BEL} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, method, target, state, targets FROM d",
    "belief_events": f"""{_BEL}, f AS (SELECT *, CASE WHEN state = 'ambiguous' THEN targets ELSE '' END AS wavering, min(CASE WHEN target IS NOT NULL THEN day END) OVER (PARTITION BY user_id) AS linked FROM d), p AS (SELECT *, lag(state || coalesce(target, '') || '|' || wavering) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM f)
        SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CASE WHEN p.day = linked THEN 'linked' ELSE 'revised' END AS kind, state, target, wavering FROM p WHERE p.day = linked OR (p.day > linked AND prev IS DISTINCT FROM state || coalesce(target, '') || '|' || wavering)""",
    "asof_lookup": f"""{_SCD}, p AS (SELECT o_orderkey, o_custkey AS user_id, make_timestamp(2024, 1, day(o_orderdate), 12, 0, 0) AS at_ FROM orders), t AS (SELECT * FROM s WHERE valid_to IS NULL OR valid_to > valid_from)
        SELECT o_orderkey, t.event_id, t.event_type FROM p ASOF LEFT JOIN t ON t.user_id = p.user_id AND p.at_ >= t.valid_from""",
    "hot_key_scan": f"""{EVENTS_SQL} SELECT event_id, event_type, last_value(CASE WHEN value > 90 THEN event_id END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS large FROM e""",
    "hot_key_asof": f"""{EVENTS_SQL}, l AS (SELECT *, floor(value / 34)::BIGINT AS level, lag(floor(value / 34)) OVER w AS p, row_number() OVER w AS n FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
        s AS (SELECT event_type, event_id, level, ts AS valid_from, lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS valid_to FROM l WHERE n = 1 OR p IS DISTINCT FROM level), t AS (SELECT * FROM s WHERE valid_to IS NULL OR valid_to > valid_from),
        p AS (SELECT o_orderkey, [{', '.join(f"'{t}'" for t in TYPES)}][o_orderpriority[1]::INT] AS event_type, make_timestamp(2024, 1, day(o_orderdate), (o_orderkey // 3600) % 24, 0, 0) AS at_ FROM orders)
        SELECT o_orderkey, t.event_id, t.level FROM p ASOF LEFT JOIN t ON t.event_type = p.event_type AND p.at_ >= t.valid_from""",
    "open_segments": """WITH r AS (SELECT o_custkey, o_orderpriority[1] AS target, o_orderdate::DATE AS since, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE + (o_orderkey % 200 - 5)::INT END AS until FROM orders), v AS (SELECT * FROM r WHERE until IS NULL OR until >= since),
        b AS (SELECT o_custkey, since AS at_ FROM v UNION SELECT o_custkey, until + 1 FROM v WHERE until IS NOT NULL), n AS (SELECT o_custkey, at_, lead(at_) OVER (PARTITION BY o_custkey ORDER BY at_) AS next FROM b),
        s AS (SELECT n.o_custkey, at_, next, string_agg(DISTINCT target, ',' ORDER BY target) AS targets FROM n LEFT JOIN v ON v.o_custkey = n.o_custkey AND since <= at_ AND (until IS NULL OR at_ <= until) GROUP BY ALL),
        g AS (SELECT *, sum(CASE WHEN p IS NOT DISTINCT FROM targets THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY at_) AS grp FROM (SELECT *, lag(targets) OVER (PARTITION BY o_custkey ORDER BY at_) AS p FROM s))
        SELECT o_custkey, strftime(min(at_), '%Y-%m-%d') AS valid_from, CASE WHEN count(*) = count(next) THEN strftime(max(next), '%Y-%m-%d') END AS valid_to, any_value(targets) AS targets FROM g WHERE targets IS NOT NULL GROUP BY o_custkey, grp""",
    "interval_changes": f"""{EVENTS_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rank, ts, event_id) AS n FROM e), v AS (SELECT user_id, day, CASE WHEN value > 10 THEN value END AS value, CASE WHEN event_id % 3 <> 0 THEN ts END AS at_ FROM c WHERE n = 1),
        p AS (SELECT *, lag(v.day) OVER w AS pd, lag(value) OVER w AS pv, lag(at_) OVER w AS pa FROM v WINDOW w AS (PARTITION BY user_id ORDER BY v.day)), g AS (SELECT *, CASE WHEN at_ IS NOT NULL AND pa IS NOT NULL THEN (epoch_us(at_) - epoch_us(pa)) / 86400e6 ELSE date_diff('day', pd, p.day) END AS el FROM p WHERE pd IS NOT NULL)
        SELECT user_id, strftime(pd, '%Y-%m-%d') AS previous_day, strftime(day, '%Y-%m-%d') AS day, round(el, 6) AS elapsed_days, round(value - pv, 6) AS change, round((value - pv) / el, 6) AS change_per_day, round(CASE WHEN pv > 0 THEN (value - pv) / pv END, 6) AS relative_change,
        CASE WHEN at_ IS NOT NULL AND pa IS NOT NULL THEN 'fetched_at' ELSE 'date' END AS basis FROM g""",
    "trajectory_features": f"{_FEAT} SELECT * FROM ft",
    "shape_features": f"{_SHAPE} SELECT * FROM sh",
    "screens": f"""{_SHAPE}, t AS (SELECT unnest(['low', 'middle', 'high']) AS name, unnest([0.0, 0.5, 1.0]) AS least) SELECT name, count_if(relative_change > least) AS grew, count_if(volatility > least) AS volatile, count_if(reversals > 10 * least) AS turning FROM fs CROSS JOIN t GROUP BY name""",
    "case_pick": f"""{_SHAPE}, ca AS (SELECT user_id, 'growth' AS reason, relative_change AS score FROM fs WHERE relative_change IS NOT NULL ORDER BY score DESC, user_id LIMIT 1),
        cb AS (SELECT user_id, 'volatility' AS reason, volatility AS score FROM fs WHERE volatility IS NOT NULL AND user_id NOT IN (SELECT user_id FROM ca) ORDER BY score DESC, user_id LIMIT 1),
        cc AS (SELECT user_id, 'variation' AS reason, total_variation AS score FROM fs WHERE n_days > 5 AND user_id NOT IN (SELECT user_id FROM ca UNION SELECT user_id FROM cb) ORDER BY score DESC, user_id LIMIT 1)
        SELECT * FROM ca UNION ALL SELECT * FROM cb UNION ALL SELECT * FROM cc""",
    "cohort_sample": """WITH p AS (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100), r AS (SELECT c_custkey FROM customer WHERE c_custkey % 40 = 0 AND c_custkey NOT IN (SELECT c_custkey FROM p) ORDER BY c_custkey DESC LIMIT 100),
        o AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY sha256('["s1","repository","' || c_custkey || '"]'), c_custkey) AS turn FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM p UNION SELECT c_custkey FROM r)),
        s AS (SELECT c_custkey FROM o ORDER BY turn, sha256('["s1","organization","' || c_nationkey || '"]'), c_custkey LIMIT (SELECT 300 - (SELECT count(*) FROM p) - (SELECT count(*) FROM r)))
        SELECT c_custkey, 'popular' AS stratum FROM p UNION ALL SELECT c_custkey, 'recent' FROM r UNION ALL SELECT c_custkey, 'remaining' FROM s""",
    "worklist": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')",
    "seeded_digest": """WITH p AS (SELECT c_nationkey, sha256(c_custkey::VARCHAR)[1:3] AS part, count(*) AS n, sha256(string_agg(c_custkey::VARCHAR, chr(10) ORDER BY c_custkey::VARCHAR)) AS dg FROM customer GROUP BY 1, 2),
        q AS (SELECT c_nationkey, sum(n)::BIGINT AS n, sha256(string_agg(dg, chr(10) ORDER BY part)) AS digest FROM p GROUP BY 1), k AS (SELECT c_nationkey, min(sha256('["' || c_name || '","' || c_mktsegment || '"]')) AS least_key FROM customer GROUP BY 1) SELECT * FROM q JOIN k USING (c_nationkey)""",
    "iso_parse": """WITH t AS (SELECT o_orderkey AS k, o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders), x AS (SELECT *, CASE WHEN k % 5 = 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN 'soon' WHEN k % 13 = 0 THEN day || 'T10:20:30+02:00' WHEN k % 17 = 0 THEN strftime(o_orderdate, '%Y') ELSE day || 'T01:02:03Z' END AS s FROM t),
        y AS (SELECT *, CASE WHEN k % 19 = 0 THEN o_orderdate WHEN regexp_full_match(s, '\\d{8}') THEN try_strptime(s, '%Y%m%d') WHEN regexp_matches(s, '^\\d{4}-\\d{2}-\\d{2}') THEN timezone('UTC', try_cast(s AS TIMESTAMPTZ)) END AS at_ FROM x)
        SELECT k AS o_orderkey, strftime(at_, '%Y-%m-%d %H:%M:%S') AS "at", (k % 19 = 0 OR s <> '') AND at_ IS NULL AS bad, regexp_matches(s, '(Z|[+-]\\d\\d:?\\d\\d)$') AS strict FROM y""",
    "id_regex": r"""WITH r AS (SELECT doc_id AS k, lpad((doc_id % 24)::VARCHAR, 2, '0') || lpad((doc_id % 14)::VARCHAR, 2, '0') || '.' || lpad((n_chars % 3000)::VARCHAR, CASE WHEN doc_id % 2 = 0 THEN 4 ELSE 5 END, '0') AS modern, CASE doc_id % 4 WHEN 0 THEN 'hep-th/' WHEN 1 THEN 'math.AG/' ELSE 'Q-BIO/' END || lpad((doc_id % 9)::VARCHAR, 7, '0') AS old FROM documents),
        w AS (SELECT k, CASE WHEN k % 2 = 0 THEN 'arXiv:' WHEN k % 7 = 1 THEN 'ARXIV:' ELSE ' ' END || CASE WHEN k % 5 = 0 THEN old ELSE modern END || CASE k % 3 WHEN 0 THEN 'v2' WHEN 1 THEN 'V11' ELSE '' END || CASE WHEN k % 11 = 0 THEN 'x' ELSE ' ' END AS raw FROM r),
        b AS (SELECT k, regexp_replace(regexp_replace(trim(raw), '^arXiv:', ''), '^arxiv:', '') AS bare FROM w), i AS (SELECT k, CASE WHEN regexp_full_match(bare, '([a-z-]+(\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(v\d+)?', 'i') THEN regexp_replace(bare, '[vV]\d+$', '') END AS p FROM b)
        SELECT k AS doc_id, p AS paper, coalesce(CASE WHEN regexp_full_match(p, '\d{4}\.\d{4,5}') THEN p[3:4]::INT BETWEEN 1 AND 12 AND regexp_extract(p, '\.(\d+)$', 1)::INT > 0 AND (p[1:2]::INT > 7 OR (p[1:2]::INT = 7 AND p[3:4]::INT >= 4)) ELSE regexp_extract(p, '(\d+)$', 1)::INT > 0 END, false) AS valid FROM i""",
    "json_props": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, json_extract(props, '$.k') IS NULL AS bad FROM events",
    "tag_lists": """WITH t AS (SELECT p_partkey, p_size, p_type, '2301.0000' || (p_partkey % 7 + 1) AS a, CASE WHEN p_size > 20 THEN '2301.00003' END AS b, CASE WHEN p_size > 40 THEN 'hep-th/9901001' END AS c FROM part)
        SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([a, b, c], lambda x: x IS NOT NULL))), ',') AS papers, CASE WHEN p_size > 30 THEN 'quantized:' ELSE '' END || p_type AS base FROM t""",
    "url_parts": r"""WITH o AS (SELECT page_id AS k, url, regexp_extract(url, '^[a-z]+://[^/?#]+(.*)$', 1) AS own FROM pages),
        u AS (SELECT k, CASE k % 6 WHEN 0 THEN 'https://huggingface.co' || own WHEN 1 THEN 'https://u@WWW.HuggingFace.co:443/' || own WHEN 2 THEN 'https://huggingface.co/datasets' || own WHEN 3 THEN 'https://huggingface.co.example.com' || own WHEN 4 THEN 'http://huggingface.co/papers/' || own ELSE url END AS url FROM o),
        h AS (SELECT k, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), '^.*@', ''), ':\d+$', '') AS host, string_split(trim(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'), '/') AS p FROM u)
        SELECT k AS page_id, host, CASE WHEN host IN ('huggingface.co', 'www.huggingface.co') AND len(p) >= 2 AND p[1] NOT IN ('datasets', 'spaces', 'collections', 'papers') THEN p[1] || '/' || p[2] END AS repo FROM h""",
    "share_long": "WITH l AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS position, unnest(embedding)::DOUBLE AS share FROM embeddings) SELECT label, position::INT AS position, count(*) AS n, round(sum(share), 3) AS total FROM l GROUP BY 1, 2",
    "scalar_dates": """SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS week, strftime(o_orderdate, '%Y-%m') AS month, date_diff('day', o_orderdate::DATE, DATE '2001-12-31')::INT AS age, strftime(o_orderdate::DATE + 30, '%Y-%m-%d') AS milestone, day(o_orderdate)::INT AS spine, 'second' AS precision FROM orders""",
    "scalar_labels": """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS label, CASE WHEN c_mktsegment = 'BUILDING' THEN split_part(c_name, '#', 1) ELSE c_mktsegment END AS author,
        c_mktsegment = 'BUILDING' AND c_custkey % 9 <= 4 AS is_primary, CASE WHEN c_acctbal > 0 THEN round((10000 - c_acctbal) / c_acctbal, 6) END AS relative FROM customer""",
    "price_normalise": """WITH r AS (SELECT p_partkey AS k, p_brand, p_size::VARCHAR AS z, round(p_retailprice * 100)::BIGINT::VARCHAR AS c FROM part),
        n AS (SELECT *, CASE k % 8 WHEN 0 THEN z || '.10' WHEN 1 THEN '00' || z || '.1' WHEN 2 THEN z || '1e-1' WHEN 3 THEN '-' || c || 'E-2' WHEN 4 THEN '-0.00' WHEN 5 THEN z || 'e-30' WHEN 6 THEN '+' || c || '.0e50' ELSE 'free' END AS s, CASE k % 8 WHEN 5 THEN '0.' || repeat('0', 30 - length(z)) || z || '0' WHEN 6 THEN c || repeat('0', 50) ELSE z || '.1' END AS o,
          CASE k % 8 WHEN 3 THEN '-' || regexp_replace(c[:-3] || '.' || c[-2:], '\\.?0+$', '') WHEN 4 THEN '0' WHEN 5 THEN '0.' || repeat('0', 30 - length(z)) || rtrim(z, '0') WHEN 6 THEN c || repeat('0', 50) WHEN 7 THEN 'free' ELSE z || '.1' END AS v FROM r)
        SELECT k AS p_partkey, CASE WHEN s = 'free' THEN 'text' ELSE 'decimal' END AS kind, v AS number, k % 8 IN (0, 1, 2, 5, 6) AS same, array_to_string(list_filter([CASE WHEN s <> o THEN 'prompt' END, CASE WHEN k % 4 <> 0 AND p_brand <> 'token' THEN 'unit' END], lambda v: v IS NOT NULL), ',') AS changed FROM n""",
}
