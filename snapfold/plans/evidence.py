"""Queries of identity, deployments, follow-up and rules, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import calendar, dedup, deployments, followup, identity, links, quality, rules, sampling, trajectories, usage
from .binding import EVENTS_SQL, TYPES, day_text, events, iso, table, user_days
from .usage import january, orders

SECONDS = "yyyy-MM-dd HH:mm:ss"


def text_of(c):
    return F.date_format(c, SECONDS).alias(c)


# --- identity ---------------------------------------------------------------------------------------------------------


def _target():
    return F.concat(F.lit("r/"), F.floor(F.col("value") / 34))


def _facts(spark, d):
    """Purchases and views declare a target, the day they are of is their instant."""
    return events(spark, d).select(
        F.col("user_id").alias("deployment_key"), F.col("event_id").alias("observation_id"), F.when(F.col("event_type").isin("purchase", "view"), _target()).alias("target"), F.date_trunc("day", "ts").alias("observed_at")
    )


def _ledger(spark, d):
    """Clicks, signups and errors review the targets of their users."""
    method = F.when(F.col("event_type") == "click", identity.METHODS[1]).when(F.col("event_type") == "signup", identity.METHODS[3]).when(F.col("event_type") == "error", identity.METHODS[4])
    return events(spark, d).where(method.isNotNull()).select(
        F.col("event_id").alias("observation_id"), method.alias("method"), F.when(F.col("event_id") % 11 != 0, _target()).alias("target"), F.when(F.col("event_type") == "signup", F.concat(F.lit("c"), F.floor(F.col("value") / 50))).alias("canonical"),
        F.when(F.col("event_id") % 3 == 0, "pending").otherwise("approved").alias("review_status"), F.when(F.col("event_id") % 13 != 0, F.date_trunc("day", "ts")).alias("available_at"),
        F.when(F.col("event_id") % 17 != 0, F.lit("ref")).alias("evidence_reference"), F.when(F.col("event_id") % 5 != 0, F.lit("who")).alias("reviewed_by"), F.lit("why").alias("review_reason"),
    )


def _decisions(spark, d):
    return identity.decisions(identity.candidates(_facts(spark, d), _ledger(spark, d)))


def identity_decisions(spark, d):
    out = _decisions(spark, d)
    return out.select("deployment_key", text_of("valid_from"), text_of("valid_to"), "method", "state", "target", "canonical", "canonical_status", F.array_join("targets", ",").alias("targets"))


def identity_events(spark, d):
    out = identity.belief_events(_decisions(spark, d), "deployment_key", "valid_from")
    return out.select("deployment_key", text_of("valid_from"), "kind", "state", "target", F.array_join("wavering", ",").alias("wavering"))


def identity_lookup(spark, d):
    probes = orders(spark, d).select("o_orderkey", F.col("o_custkey").alias("deployment_key"), F.expr("make_timestamp_ntz(2024, 1, dayofmonth(day), 12, 0, 0)").alias("at"))
    out = identity.identity_at(probes, _decisions(spark, d), "deployment_key", "at", "2024-02-01T00:00:00Z")
    return out.select("o_orderkey", "state", "target")


def evidence_rules(spark, d):
    late = F.when(F.col("observation_id") % 7 == 0, F.timestamp_add("DAY", F.lit(-1), F.col("available_at"))).otherwise(F.col("available_at"))
    ledger = _ledger(spark, d).withColumn("available_at", late)
    ledger = ledger.withColumn("method", F.when(F.col("observation_id") % 101 == 0, identity.METHODS[0]).otherwise(F.col("method")))
    return identity.evidence_violations(ledger, _facts(spark, d), F.lit("2024-01-25").cast("timestamp_ntz"))


def uniqueness_rules(spark, d):
    rows = events(spark, d).select("event_id", "ts")
    return rules.unique_and_past(rows.unionByName(rows.where("event_id % 1000 = 0")), "event_id", "ts", F.lit("2024-01-29").cast("timestamp_ntz"), "event")


def identity_merge(spark, d):
    """Orders meet the declarations of their customer's namesake on the same day, and reviews that hold for a part of the month."""
    e = events(spark, d)
    declared = e.groupBy("day", "user_id").agg(F.collect_set(F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("t/"), "event_type"))).alias("declared"))
    c = table(spark, d, "customer")
    reviews = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 2 == 0, "t/purchase").otherwise("t/click").alias("target"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 9).cast("int")).alias("valid_from"), F.lit("2024-01-20").cast("date").alias("valid_until"), F.lit("who").alias("reviewer"), F.lit("ref").alias("evidence"))
    facts = orders(spark, d).select("o_orderkey", january("day").alias("day"), F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").startswith("5").alias("is_other"))
    reviewed = usage.in_force(facts, reviews, "user_id", "day").withColumnRenamed("targets", "reviewed").drop("state")
    both = reviewed.join(declared, ["day", "user_id"], "left")
    return both.select("o_orderkey", *identity.merged(F.col("declared"), F.col("reviewed"), F.col("is_other")))


# --- deployments ------------------------------------------------------------------------------------------------------


def _rows(spark, d):
    """A line of an order is a fact: of a part (deployment) from a source (supplier's remainder), in the snapshot of a month; some lack an instant."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey")).alias("key"), (F.col("l_suppkey") % 2).cast("string").alias("source"), F.date_format("l_shipdate", "yyyy-MM").alias("snapshot"), F.to_date("l_shipdate").alias("day"),
        F.when(F.col("l_quantity") < 46, F.col("l_shipdate")).alias("at"), F.when(F.col("l_linenumber") < 6, F.concat(F.lit("r"), "l_suppkey")).alias("target"), "l_discount", "l_tax", "l_returnflag",
    )


def _runs(spark, d):
    snapshots = _rows(spark, d).select("source", "snapshot").distinct()
    return snapshots.select("source", "snapshot", F.col("snapshot").alias("day"), F.when(F.col("snapshot").endswith("-11"), "not_applicable").otherwise("ok").alias("leg_status"))


def _rolled(spark, d):
    return deployments.roll_up(_rows(spark, d), _runs(spark, d), "key", "source", "snapshot", "day", "at", "target")


def deployment_rollup(spark, d):
    return _rolled(spark, d).select("key", day_text("first_day"), text_of("first_at"), day_text("last_day"), text_of("last_at"), "n_rows", "n_snapshots", F.array_join("targets", ",").alias("targets"), "state", "as_of_day", "n_sources")


def layer_summary(spark, d):
    rows = _rows(spark, d)
    return deployments.summary(rows, _rolled(spark, d), "key", "snapshot", "at", ["source", "snapshot"])


def source_runs(spark, d):
    e = events(spark, d)
    told = e.where("event_type <> 'view' or dayofmonth(day) % 4 <> 0").groupBy("day", F.col("event_type").alias("leg")).agg(F.lit("ok").alias("status")).withColumn("day_status", F.when(F.dayofmonth("day") % 3 == 0, "complete").otherwise("partial"))
    snapshots = e.groupBy(F.col("event_type").alias("source"), F.col("day").alias("collection_day")).agg(F.min("event_id").alias("snapshot_id"))
    return deployments.source_runs(told, TYPES, snapshots).select("source", day_text("day"), "run_status", "leg_status", "snapshot_id")


def _batches(spark, d):
    value = F.create_map(F.lit("discount"), F.col("l_discount").cast("string"), F.lit("unit"), F.col("l_returnflag"))
    return deployments.batches(_rows(spark, d).where("key is not null"), ["key", "source"], "snapshot", "day", "at", value)


def batch_alignment(spark, d):
    out = _batches(spark, d)
    return out.select("key", "source", "snapshot", text_of("batch_at"), day_text("batch_day"), "barrier", F.try_element_at("value", F.lit("discount")).try_cast("double").alias("discount"))


def change_events(spark, d):
    out = deployments.changes(_batches(spark, d), ["key", "source"], ["unit"])
    number = lambda c: F.try_element_at(c, F.lit("discount")).cast("double")
    return out.select("key", "source", text_of("at"), number("previous").alias("previous"), number("value").alias("current"), F.array_join("changed", ",").alias("changed"))


def first_listing(spark, d):
    rows = _rows(spark, d).withColumn("day", F.when(F.col("l_tax") < 0.08, F.col("day")))
    return deployments.first_listing(rows, "key", "day", "at").select("key", day_text("first_day"), text_of("first_at"))


# --- follow-up --------------------------------------------------------------------------------------------------------


def _members(spark, d):
    c = table(spark, d, "customer")
    enrolled = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 40).cast("int")), "yyyy-MM-dd'T'00:00:00'Z'")
    return c.select(F.lit("c1").alias("cohort_id"), F.lit("2024-01-01T00:00:00Z").alias("selected_at"), F.concat(F.lit("u/"), "c_custkey").alias("hf_repo_id"), F.col("c_mktsegment").alias("selection_group"), F.when(F.col("c_custkey") % 6 != 0, True).otherwise(False).alias("active"), enrolled.alias("enrolled_at"))


def _found(spark, d):
    repo = F.concat(F.lit("u/"), "user_id")
    return events(spark, d).select(
        repo.alias("hf_repo_id"), F.when(F.col("event_id") % 7 == 0, F.concat(repo, F.lit("-new"))).otherwise(repo).alias("id"), F.lit(None).cast("string").alias("model_id"), F.col("value").alias("downloads"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("likes"),
        F.when(F.col("event_id") % 9 == 0, 404).otherwise(200).alias("http_status"), F.col("event_type").alias("source_leg"), "day", "event_id",
    )


DAY = "2024-01-20"


def _polled(spark, d):
    members = followup.enrolled(_members(spark, d), F.lit(DAY).cast("date"))
    found = _found(spark, d).where(F.col("day") == F.lit(DAY).cast("date")).drop("day")
    return members, followup.observed(members, found, TYPES), found


def followup_list(spark, d):
    """Members seen by other sources on the day, and those that are left to poll."""
    members, seen, found = _polled(spark, d)
    settled = found.where("http_status = 404").select("hf_repo_id").distinct()
    left = followup.to_poll(members, seen, settled).select("hf_repo_id", F.lit("to_poll").alias("what"), F.lit("").alias("sources"))
    return seen.select("hf_repo_id", F.lit("observed").alias("what"), F.array_join("discovery_sources", ",").alias("sources")).unionByName(left)


def poll_coverage(spark, d):
    members, seen, found = _polled(spark, d)
    failed = found.where("http_status = 404").join(seen, "hf_repo_id", "left_anti").groupBy("hf_repo_id").agg(F.min(F.concat(F.lit("gone_"), "source_leg")).alias("reason"))
    left = members.join(seen, "hf_repo_id", "left_anti").join(failed, "hf_repo_id", "left_anti").select("hf_repo_id", F.lit("budget").alias("reason"))
    return followup.poll_coverage(members, seen, failed, left, ["purchase", "signup"])


def identity_reviews(spark, d):
    found = _found(spark, d).withColumn("reason", scalars.response_reason(F.col("hf_repo_id"), F.col("id"), F.col("model_id"), F.col("downloads"), F.col("likes")))
    out = followup.identity_reviews(found.select("day", "hf_repo_id", F.col("id").alias("response_id"), "http_status", "reason", "event_id"), _members(spark, d))
    return out.groupBy(day_text("day"), "selection_group", "requested_id", "response_id", "http_status", "decision").agg(F.count("*").alias("n"))


def response_verdicts(spark, d):
    f = _found(spark, d)
    reason = scalars.response_reason(F.col("hf_repo_id"), F.col("id"), F.col("model_id"), F.col("downloads"), F.col("likes"))
    measured = F.when(F.col("event_id") % 2 == 0, F.col("day")).otherwise(F.date_add("day", 1))
    final = scalars.terminal_failure(F.col("http_status"), reason, F.col("hf_repo_id"), F.col("id"), F.array("id"), measured, F.col("day"))
    return f.select("event_id", reason.alias("reason"), final.alias("terminal"))


def wanted_ids(spark, d):
    declared = table(spark, d, "part").select(F.when(F.col("p_size") > 25, F.concat(F.lower("p_brand"), F.lit("/"), F.col("p_size").cast("string"))).when(F.col("p_size") > 10, "").alias("hugging_face_id"))
    return followup.wanted_ids(declared)


def eligibility(spark, d):
    c = table(spark, d, "customer")
    repo = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit(".bad/"), "c_custkey")).when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("a b/"), "c_custkey")).when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("solo."), "c_custkey")).otherwise(F.concat(F.lit("o-1/m_"), "c_custkey", F.lit(".v2")))
    likes = F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey"))
    closed = F.when(F.col("c_custkey") % 10 == 3, F.lit(True))
    return c.select("c_custkey", scalars.valid_repo(repo).alias("valid_id"), scalars.valid_counts(F.col("c_acctbal"), likes).alias("valid_counts"), scalars.eligible(repo, F.col("c_acctbal"), likes, closed, F.lit(None).cast("boolean")).alias("eligible"))


# --- labels, flags and counts -----------------------------------------------------------------------------------------


def observation_labels(spark, d):
    by = events(spark, d).groupBy("user_id").agg(F.min("day").alias("first_day"), F.min(F.when(F.col("event_type") == "purchase", F.col("day"))).alias("bought"))
    other = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.min(january(F.col("o_orderdate"))).alias("ordered"))
    both = by.join(other, "user_id", "left")
    return both.select(
        "user_id", scalars.observation_order(F.col("ordered"), F.col("first_day")).alias("order"), scalars.left_censored(F.col("bought"), F.col("first_day")).alias("censored_purchase"), scalars.left_censored(F.col("ordered"), F.col("first_day"), True).alias("censored_order"),
        iso(scalars.observation_date(F.col("bought").cast("timestamp_ntz"), F.col("first_day"))).alias("observed"),
    )


def _linked(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    urgent = o.where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return {"sold": li.select(F.col("l_partkey").alias("p_partkey")), "returned": li.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")), "urgent": li.join(urgent, li["l_orderkey"] == urgent["o_orderkey"]).select(F.col("l_partkey").alias("p_partkey"))}


def existence_flags(spark, d):
    return links.flags(table(spark, d, "part").select("p_partkey"), "p_partkey", _linked(spark, d))


def coverage_counts(spark, d):
    return links.coverage_counts(table(spark, d, "part"), "p_partkey", _linked(spark, d))


def status_histogram(spark, d):
    li = table(spark, d, "lineitem").select(F.nullif("l_returnflag", F.lit("N")).alias("lookup"), F.col("l_linestatus").alias("status"))
    return links.status_histogram(li, ["lookup", "status"])


def reference_spellings(spark, d):
    docs = table(spark, d, "documents")
    number = F.concat(F.lit("23"), F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0"), F.lit("."), F.lpad((F.col("doc_id") % 50 + 1).cast("string"), 5, "0"))
    raw = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("arXiv:"), number, F.lit("v1"))).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("x"), number)).when(F.col("doc_id") % 5 == 2, F.concat(F.lit("hep-th/"), F.lpad((F.col("doc_id") % 40).cast("string"), 7, "0"), F.lit("V2"))).otherwise(number)
    wanted = docs.select(scalars.paper_id(F.when(F.col("doc_id") % 3 == 0, raw).otherwise(F.concat(number, F.lit("")))).alias("paper")).where("paper is not null")
    told, malformed = links.references(docs.select(raw.alias("tag")), "tag", scalars.paper_id(F.col("tag")), wanted, "paper")
    return told.select(F.col("paper").alias("id"), F.array_join("originals", ",").alias("spellings")).unionByName(malformed.select(F.col("raw").alias("id"), F.lit("malformed").alias("spellings")))


def missing_metrics(spark, d):
    seen = events(spark, d).select("user_id", "day", F.col("event_type").alias("metric"))
    out = calendar.missing_metrics(seen.select("user_id"), seen, ["purchase", "view"], "2024-01-01", "2024-01-31", "day")
    return out.withColumn("day", iso("day"))


def json_leaves(spark, d):
    body = F.to_json(F.struct(F.struct(F.col("p_size").alias("b"), F.when(F.col("p_size") > 20, F.col("p_brand")).alias("c"), F.struct(F.array("p_type", "p_brand").alias("e")).alias("d")).alias("a"), (F.col("p_size") > 10).alias("f")))
    leaf = scalars.leaves(F.parse_json(body))
    return table(spark, d, "part").select("p_partkey", F.explode(leaf).alias("path", "value"))


def extract_profile(spark, d):
    return quality.extract_profile(events(spark, d), "day", "event_type", "user_id").withColumn("day", iso("day"))


def research_summary(spark, d):
    rows = user_days(spark, d).withColumn("value", F.when(F.col("value") > 10, F.col("value")))
    return trajectories.research_summary(rows, "user_id", "day", "event_type", ["value", "props"], "2024-01-20")


def latest_request(spark, d):
    o = orders(spark, d).select("o_custkey", "day", "o_orderpriority", "o_orderkey")
    out = dedup.latest_request(o, "o_custkey", "day", ~F.col("o_orderpriority").startswith("1"))
    return out.select("o_custkey", day_text("day"))


# --- rules ------------------------------------------------------------------------------------------------------------


def usage_rules(spark, d):
    o = orders(spark, d)
    share = usage.shares(o, ["month"], "o_orderpriority", "o_totalprice").select("month", F.col("o_orderpriority").alias("name"), F.col("share_percent").alias("value"))
    share = share.where("not (month like '%-03' and name like '5%')").withColumn("value", F.when(F.col("month").endswith("-07") & F.col("name").startswith("2"), -F.col("value")).otherwise(F.col("value")))
    share = share.unionByName(share.where("month like '%-09' and name like '4%'"))
    return rules.usage_rules(share, ["month"], "name", "value", F.col("name").startswith("5"), F.lit(True)).groupBy("month", "rule").agg(F.count("*").alias("n"))


def _series(spark, d):
    e = events(spark, d).where("not (event_type = 'error' and dayofmonth(day) = 9)")
    by = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    total = by.groupBy("day").agg(F.sum("n").alias("total"))
    rows = by.join(total, "day").select(F.lit("s").alias("series"), F.col("event_type").alias("name"), F.dayofmonth("day").alias("position"), "day", (100 * F.col("n") / F.col("total") + F.when((F.dayofmonth("day") == 12) & (F.col("event_type") == "view"), 1).otherwise(0)).alias("share"))
    again = rows.where("position = 5").withColumn("position", F.lit(105))
    return rows.unionByName(again)


def series_rules(spark, d):
    return rules.series_rules(_series(spark, d), "series", "name", "position", "day", "share", "2024-01-03", "2024-02-03")


def series_quality(spark, d):
    return rules.series_quality(_series(spark, d), "series", "name", "position", "day", "2024-01-03", "2024-01-20")


def lifecycle_rules(spark, d):
    e = events(spark, d)
    life = e.groupBy("user_id").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.min(F.when(F.col("value") > 90, F.col("day"))).alias("large"), F.max_by("value", "ts").alias("value"), F.count_if(F.col("event_type") == "click").alias("route_count"))
    follow = F.date_diff(F.lit("2024-01-30").cast("date"), F.col("first"))
    life = life.select("user_id", (F.date_diff("first", F.lit("2024-01-01").cast("date")) - (F.col("user_id") % 2)).alias("age_days"), follow.alias("followup_days"), "route_count", (F.date_diff("large", "first") - 1).alias("days_to_large"), (follow >= F.when(F.col("user_id") % 9 == 0, 7).otherwise(8)).alias("eligible_7"), F.when(F.col("user_id") % 4 == 0, F.col("value")).alias("milestone_7"))
    life = life.unionByName(life.where("user_id % 40 = 0"))
    routes = e.where("event_type = 'click' and not (user_id % 30 = 0)")
    kinds = e.where("event_type = 'signup'").select("user_id", F.col("event_type").alias("kind"))
    return rules.lifecycle_rules(life, kinds, routes, "user_id", [7]).groupBy("subject", "rule").agg(F.count("*").alias("n"))


def registry_rules(spark, d):
    m = _members(spark, d)
    n = F.substring_index("hf_repo_id", "/", -1).cast("long")
    m = m.withColumn("hf_repo_id", F.when(n % 8 == 0, F.concat(F.lit("-/ "), "hf_repo_id")).otherwise(F.col("hf_repo_id"))).withColumn("enrolled_at", F.when(n % 9 == 0, F.substring("enrolled_at", 1, 19)).otherwise(F.col("enrolled_at"))).withColumn("cohort_id", F.when(n % 100 == 1, "no id").otherwise(F.col("cohort_id")))
    return rules.registry_rules(m.unionByName(m.where(n % 25 == 0)))


def frozen_inputs(spark, d):
    c = table(spark, d, "customer")
    told = sampling.population(c, "c_mktsegment", "c_custkey")
    found = sampling.population(c.where("not (c_mktsegment = 'BUILDING' and c_custkey % 50 = 0) and c_mktsegment <> 'MACHINERY'"), "c_mktsegment", "c_custkey")
    return rules.frozen(told, found, "c_mktsegment")


def stale_index(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sum"))
    fresh = table(spark, d, "documents").select("doc_id", F.sha2(F.when(F.col("doc_id") % 19 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sum")).where("doc_id % 23 <> 0")
    return rules.stale_index(docs, fresh)


def reconciliation(spark, d):
    source = trajectories.features(user_days(spark, d), "user_id", "day", "value").select("user_id", F.col("n_days").cast("double").alias("n_days"), F.col("last_value").alias("last_value"))
    stored = source.where("user_id % 21 <> 0").withColumn("n_days", F.when(F.col("user_id") % 10 == 0, F.col("n_days") + 1).otherwise(F.col("n_days"))).withColumn("last_value", F.when(F.col("user_id") % 15 == 0, None).otherwise(F.col("last_value")))
    extra = source.where("user_id % 33 = 0").withColumn("user_id", -F.col("user_id") - 1)
    return rules.reconciled(source, stored.unionByName(extra), ["user_id"], ["n_days", "last_value"])


QUERIES = {f.__name__: f for f in (
    identity_decisions, identity_events, identity_lookup, evidence_rules, uniqueness_rules, identity_merge, deployment_rollup, layer_summary, source_runs, batch_alignment, change_events, first_listing, followup_list, poll_coverage,
    identity_reviews, response_verdicts, wanted_ids, eligibility, observation_labels, existence_flags, coverage_counts, status_histogram, reference_spellings, missing_metrics, json_leaves, extract_profile, research_summary, latest_request, usage_rules, series_rules, series_quality,
    lifecycle_rules, registry_rules, frozen_inputs, stale_index, reconciliation,
)}

_DEC = f"""{EVENTS_SQL}, b AS (SELECT user_id AS k, event_type AS ty, CASE WHEN event_type IN ('purchase', 'view') OR event_id % 13 <> 0 THEN date_trunc('day', ts)::TIMESTAMP END AS at_,
  CASE WHEN event_type IN ('purchase', 'view') OR event_id % 11 <> 0 THEN 'r/' || floor(value / 34)::INT END AS t, CASE WHEN event_type = 'signup' THEN 'c' || floor(value / 50)::INT END AS c, event_type IN ('purchase', 'view') OR (event_id % 3 <> 0 AND event_type <> 'error') AS ok FROM e),
i AS (SELECT k, at_, list_sort(list(DISTINCT {{'t': t, 'c': c}}) FILTER (ok AND ty IN ('purchase', 'view'))) AS m1, list_sort(list(DISTINCT {{'t': t, 'c': c}}) FILTER (ok AND ty = 'click')) AS m2, list_sort(list(DISTINCT {{'t': t, 'c': c}}) FILTER (ok AND ty = 'signup')) AS m4 FROM b WHERE at_ IS NOT NULL GROUP BY k, at_),
h AS (SELECT k, at_, last_value(m1 IGNORE NULLS) OVER w AS m1, last_value(m2 IGNORE NULLS) OVER w AS m2, last_value(m4 IGNORE NULLS) OVER w AS m4, lead(at_) OVER (PARTITION BY k ORDER BY at_) AS until FROM i WINDOW w AS (PARTITION BY k ORDER BY at_ ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, coalesce(m1, m2, m4) AS held, CASE WHEN m1 IS NOT NULL THEN 'explicit_provider_mapping' WHEN m2 IS NOT NULL THEN 'exact_external_identifier' WHEN m4 IS NOT NULL THEN 'curated' END AS method FROM h),
q AS (SELECT *, list_distinct(list_transform(list_filter(coalesce(m4, []), lambda x: x.c IS NOT NULL AND x.t IS NOT DISTINCT FROM held[1].t), lambda x: x.c)) AS cs, list_sort(list_distinct(list_filter(list_transform(coalesce(held, []), lambda x: x.t), lambda x: x IS NOT NULL))) AS ts FROM g),
dec AS (SELECT k AS deployment_key, at_ AS valid_from, until AS valid_to, method, CASE WHEN held IS NULL THEN 'unresolved' WHEN len(held) = 1 THEN 'resolved' ELSE 'ambiguous' END AS state, CASE WHEN len(held) = 1 THEN held[1].t END AS target,
  CASE WHEN len(held) = 1 AND len(cs) = 1 THEN cs[1] END AS canonical, CASE WHEN len(held) = 1 AND len(cs) = 1 THEN 'reviewed_reference' WHEN len(held) = 1 AND len(cs) > 1 THEN 'ambiguous' ELSE 'unassigned' END AS canonical_status, coalesce(array_to_string(ts, ','), '') AS targets FROM q)"""
_T = "'%Y-%m-%d %H:%M:%S'"
_ROWS = "WITH r AS (SELECT CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS key, (l_suppkey % 2)::VARCHAR AS source, strftime(l_shipdate, '%Y-%m') AS snapshot, l_shipdate::DATE AS day, CASE WHEN l_quantity < 46 THEN l_shipdate END AS at_, CASE WHEN l_linenumber < 6 THEN 'r' || l_suppkey END AS target, l_discount, l_tax, l_returnflag FROM lineitem)"
_ROLL = f"""{_ROWS}, k AS (SELECT *, min(day) OVER (PARTITION BY key) AS f, max(day) OVER (PARTITION BY key) AS l FROM r WHERE key IS NOT NULL),
s AS (SELECT key, min(day) AS fd, CASE WHEN NOT bool_or(day = f AND at_ IS NULL) THEN min(CASE WHEN day = f THEN at_ END) END AS fa, max(day) AS ld, CASE WHEN NOT bool_or(day = l AND at_ IS NULL) THEN max(CASE WHEN day = l THEN at_ END) END AS la, count(*) AS n_rows, count(DISTINCT snapshot) AS n_snapshots, coalesce(string_agg(DISTINCT target, ',' ORDER BY target), '') AS targets FROM k GROUP BY key),
u AS (SELECT source, max(snapshot) AS run FROM r WHERE snapshot NOT LIKE '%-11' GROUP BY 1), o AS (SELECT key, r.source, bool_or(snapshot = run) AS there, max(run) AS d FROM r JOIN u USING (source) WHERE key IS NOT NULL GROUP BY 1, 2),
t AS (SELECT key, CASE WHEN bool_and(there) THEN 'PRESENT' ELSE 'UNKNOWN' END AS state, max(d) AS as_of_day, count(*) AS n_sources FROM o GROUP BY 1)"""
_BATCH = f"""{_ROWS}, v AS (SELECT *, l_discount::VARCHAR || '|' || l_returnflag AS tx FROM r WHERE key IS NOT NULL),
b AS (SELECT key, source, snapshot, bool_or(at_ IS NULL) AS untimed, max(at_) AS mx, max(day) AS md, count(DISTINCT tx) AS n, min(tx) AS tx, min(l_discount) AS disc, min(l_returnflag) AS unit FROM v GROUP BY 1, 2, 3),
c AS (SELECT *, CASE WHEN untimed THEN md ELSE mx::DATE END AS bd FROM b),
bt AS (SELECT key, source, snapshot, CASE WHEN NOT untimed THEN mx END AS batch_at, bd, bool_or(untimed) OVER (PARTITION BY key, source, bd) AS barrier, n, disc, unit FROM c),
bv AS (SELECT *, CASE WHEN NOT barrier AND n = 1 THEN disc END AS val, CASE WHEN NOT barrier AND n = 1 THEN unit END AS vu FROM bt)"""
_MEM = "WITH m AS (SELECT 'u/' || c_custkey AS hf_repo_id, c_custkey AS n, c_mktsegment AS g, c_custkey % 6 <> 0 AS active, DATE '2024-01-01' + (c_custkey % 40)::INT AS en FROM customer)"
_FOUND = "f AS (SELECT 'u/' || user_id AS hf_repo_id, CASE WHEN event_id % 7 = 0 THEN 'u/' || user_id || '-new' ELSE 'u/' || user_id END AS id, value AS downloads, CASE WHEN event_id % 5 <> 0 THEN value END AS likes, CASE WHEN event_id % 9 = 0 THEN 404 ELSE 200 END AS http_status, event_type, ts::DATE AS day, event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS rank FROM events)"
_SEEN = f"{_MEM}, {_FOUND}, em AS (SELECT hf_repo_id FROM m WHERE active AND en <= DATE '2024-01-20'), fd AS (SELECT f.* FROM f JOIN em USING (hf_repo_id) WHERE day = DATE '2024-01-20'), ok AS (SELECT * FROM fd WHERE http_status = 200 AND id = hf_repo_id AND downloads >= 0 AND likes >= 0)"
_REASON = "CASE WHEN id <> hf_repo_id THEN 'identity_mismatch' WHEN NOT coalesce(downloads >= 0 AND likes >= 0, false) THEN 'invalid_response' END"
_LINK = "l AS (SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem) AS sold, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS returned, p_partkey IN (SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT') AS urgent FROM part)"
_SER = f"""{EVENTS_SQL}, y AS (SELECT event_type, day, count(*) AS n FROM e WHERE NOT (event_type = 'error' AND day(e.day) = 9) GROUP BY ALL), x AS (SELECT event_type AS name, day(y.day) AS position, day, 100 * n / sum(n) OVER (PARTITION BY day) + CASE WHEN day(y.day) = 12 AND event_type = 'view' THEN 1 ELSE 0 END AS share FROM y),
s AS (SELECT * FROM x UNION ALL SELECT name, 105, day, share FROM x WHERE position = 5)"""
_LIFE = f"""{EVENTS_SQL}, a AS (SELECT user_id, min(day) AS f, min(CASE WHEN value > 90 THEN day END) AS lg, arg_max(value, ts) AS v, count_if(event_type = 'click') AS rc FROM e GROUP BY 1),
l0 AS (SELECT user_id, date_diff('day', DATE '2024-01-01', f) - user_id % 2 AS age, date_diff('day', f, DATE '2024-01-30') AS fu, rc, date_diff('day', f, lg) - 1 AS lag, date_diff('day', f, DATE '2024-01-30') >= CASE WHEN user_id % 9 = 0 THEN 7 ELSE 8 END AS el, CASE WHEN user_id % 4 = 0 THEN v END AS ms FROM a),
l AS (SELECT * FROM l0 UNION ALL SELECT * FROM l0 WHERE user_id % 40 = 0), rt AS (SELECT user_id, count(*) AS n FROM e WHERE event_type = 'click' AND user_id % 30 <> 0 GROUP BY 1)"""
_POP = "SELECT c_mktsegment, sum(n)::BIGINT AS n, sha256(string_agg(dg, chr(10) ORDER BY part)) AS digest FROM (SELECT c_mktsegment, sha256(c_custkey::VARCHAR)[1:3] AS part, count(*) AS n, sha256(string_agg(c_custkey::VARCHAR, chr(10) ORDER BY c_custkey::VARCHAR)) AS dg FROM {0} GROUP BY 1, 2) GROUP BY 1"

ORACLES = {
    "identity_decisions": f"{_DEC} SELECT deployment_key, strftime(valid_from, {_T}) AS valid_from, strftime(valid_to, {_T}) AS valid_to, method, state, target, canonical, canonical_status, targets FROM dec",
    "identity_events": f"""{_DEC}, w AS (SELECT *, CASE WHEN state = 'ambiguous' THEN targets ELSE '' END AS wavering, min(CASE WHEN target IS NOT NULL THEN valid_from END) OVER (PARTITION BY deployment_key) AS linked FROM dec),
        p AS (SELECT *, lag(state || '|' || coalesce(target, '') || '|' || wavering) OVER (PARTITION BY deployment_key ORDER BY valid_from) AS prev FROM w)
        SELECT deployment_key, strftime(valid_from, {_T}) AS valid_from, CASE WHEN valid_from = linked THEN 'linked' ELSE 'revised' END AS kind, state, target, wavering FROM p
        WHERE valid_from = linked OR (valid_from > linked AND prev IS DISTINCT FROM state || '|' || coalesce(target, '') || '|' || wavering)""",
    "identity_lookup": f"""{_DEC}, p AS (SELECT o_orderkey, o_custkey AS k, make_timestamp(2024, 1, day(o_orderdate), 12, 0, 0) AS at_ FROM orders)
        SELECT o_orderkey, coalesce(state, 'unknown') AS state, target FROM p LEFT JOIN dec ON deployment_key = k AND valid_from <= p.at_ AND (valid_to IS NULL OR p.at_ < valid_to)""",
    "evidence_rules": f"""{EVENTS_SQL}, l AS (SELECT event_id AS i, event_type AS ty, CASE WHEN event_id % 101 = 0 THEN 'explicit_provider_mapping' WHEN event_type = 'click' THEN 'exact_external_identifier' WHEN event_type = 'signup' THEN 'curated' ELSE 'fuzzy' END AS method, event_id % 11 <> 0 AS has_t, event_type = 'signup' AS has_c,
          event_id % 3 <> 0 AS approved, CASE WHEN event_id % 13 <> 0 THEN date_trunc('day', ts)::TIMESTAMP - CASE WHEN event_id % 7 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END END AS av, date_trunc('day', ts)::TIMESTAMP AS ob FROM e WHERE event_type IN ('click', 'signup', 'error'))
        SELECT i AS observation_id, 'method' AS rule FROM l WHERE method = 'explicit_provider_mapping' UNION ALL SELECT i, 'no_reference' FROM l WHERE i % 17 = 0 UNION ALL SELECT i, 'approval_without_reviewer' FROM l WHERE approved AND i % 5 = 0
        UNION ALL SELECT i, 'before_its_observation' FROM l WHERE av < ob UNION ALL SELECT i, 'from_the_future' FROM l WHERE av > TIMESTAMP '2024-01-25' UNION ALL SELECT i, 'canonical_without_review' FROM l WHERE has_c AND method NOT IN ('curated', 'fuzzy') UNION ALL SELECT i, 'no_target' FROM l WHERE NOT has_t AND NOT has_c""",
    "uniqueness_rules": "WITH u AS (SELECT event_id, ts FROM events UNION ALL SELECT event_id, ts FROM events WHERE event_id % 1000 = 0) SELECT event_id::VARCHAR AS subject, 'event_not_unique' AS rule FROM u GROUP BY event_id HAVING count(*) > 1 UNION ALL SELECT event_id::VARCHAR, 'event_from_the_future' FROM u WHERE ts > TIMESTAMP '2024-01-29'",
    "identity_merge": f"""{EVENTS_SQL}, dc AS (SELECT day, user_id, list(DISTINCT CASE WHEN event_type = 'view' THEN '' ELSE 't/' || event_type END) AS s FROM e GROUP BY 1, 2),
        rv AS (SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 't/purchase' ELSE 't/click' END AS t, DATE '2024-01-01' + (c_custkey % 9)::INT AS f FROM customer WHERE c_custkey % 4 <> 0),
        fx AS (SELECT o_orderkey, DATE '2024-01-01' + day(o_orderdate)::INT - 1 AS day, o_custkey AS user_id, o_orderpriority LIKE '5%' AS other FROM orders),
        j AS (SELECT fx.*, coalesce(s, []) AS s, list_filter(coalesce(s, []), lambda x: x <> '') AS v, CASE WHEN fx.day BETWEEN f AND DATE '2024-01-20' THEN t END AS r FROM fx LEFT JOIN dc USING (day, user_id) LEFT JOIN rv USING (user_id)),
        k AS (SELECT *, CASE WHEN r IS NULL THEN v ELSE list_distinct(list_append(v, r)) END AS ts, len(v) > 0 AND (len(s) <> 1 OR len(v) <> 1) AS op FROM j)
        SELECT o_orderkey, CASE WHEN other THEN 'aggregate' WHEN len(ts) = 1 AND NOT op THEN CASE WHEN len(v) > 0 THEN 'source_explicit' ELSE 'curated' END WHEN len(ts) > 1 OR op THEN 'ambiguous' ELSE 'unresolved' END AS identity_status, CASE WHEN len(ts) = 1 AND NOT op AND NOT other THEN ts[1] END AS target FROM k""",
    "deployment_rollup": f"{_ROLL} SELECT key, strftime(fd, '%Y-%m-%d') AS first_day, strftime(fa, {_T}) AS first_at, strftime(ld, '%Y-%m-%d') AS last_day, strftime(la, {_T}) AS last_at, n_rows, n_snapshots, targets, state, as_of_day, n_sources FROM s JOIN t USING (key)",
    "layer_summary": f"""{_ROLL} SELECT 'rows_by_source' AS measure, source AS label, count(*) AS n FROM r GROUP BY 2 UNION ALL SELECT 'rows_by_snapshot', snapshot, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'deployments_by_state', state, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'totals', 'rows', count(*) FROM r
        UNION ALL SELECT 'totals', 'unidentified', count(*) FROM r WHERE key IS NULL UNION ALL SELECT 'totals', 'day_only', count(*) FROM r WHERE at_ IS NULL UNION ALL SELECT 'totals', 'snapshots', count(DISTINCT snapshot) FROM r
        UNION ALL SELECT 'totals', 'repeated_in_snapshot', count(*) FROM (SELECT key, snapshot FROM r WHERE key IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)""",
    "source_runs": f"""{EVENTS_SQL}, tl AS (SELECT DISTINCT day, event_type FROM e WHERE event_type <> 'view' OR day(e.day) % 4 <> 0), dy AS (SELECT DISTINCT day, CASE WHEN day(tl.day) % 3 = 0 THEN 'complete' ELSE 'partial' END AS run_status FROM tl), sn AS (SELECT event_type AS source, day, min(event_id) AS snapshot_id FROM e GROUP BY 1, 2),
        gr AS (SELECT day, run_status, unnest(['purchase', 'signup', 'error', 'click', 'view']) AS source FROM dy)
        SELECT gr.source, strftime(gr.day, '%Y-%m-%d') AS day, run_status, CASE WHEN tl.day IS NOT NULL THEN 'ok' WHEN run_status = 'complete' THEN 'not_applicable' ELSE 'pending' END AS leg_status, snapshot_id FROM gr LEFT JOIN tl ON tl.day = gr.day AND tl.event_type = gr.source LEFT JOIN sn ON sn.day = gr.day AND sn.source = gr.source""",
    "batch_alignment": f"{_BATCH} SELECT key, source, snapshot, strftime(batch_at, {_T}) AS batch_at, strftime(bd, '%Y-%m-%d') AS batch_day, barrier, val AS discount FROM bv",
    "change_events": f"""{_BATCH}, pt AS (SELECT key, source, bd, batch_at AS at_, count(DISTINCT val::VARCHAR || vu) AS n, count_if(val IS NULL) AS cut, min(val) AS val, min(vu) AS vu FROM bv GROUP BY 1, 2, 3, 4), pv AS (SELECT *, CASE WHEN n = 1 AND cut = 0 THEN val END AS cv, CASE WHEN n = 1 AND cut = 0 THEN vu END AS cu FROM pt),
        lg AS (SELECT *, lag(cv) OVER w AS pval, lag(cu) OVER w AS pu FROM pv WINDOW w AS (PARTITION BY key, source ORDER BY bd, at_ NULLS FIRST))
        SELECT key, source, strftime(at_, {_T}) AS "at", pval AS previous, cv AS current, 'discount' AS changed FROM lg WHERE cv <> pval AND cu = pu""",
    "first_listing": f"""{_ROWS}, x AS (SELECT key, CASE WHEN l_tax < 0.08 THEN day END AS day, at_ FROM r WHERE key IS NOT NULL), y AS (SELECT *, min(day) OVER (PARTITION BY key) AS f FROM x)
        SELECT key, strftime(min(day), '%Y-%m-%d') AS first_day, CASE WHEN NOT bool_or(day = f AND at_ IS NULL) THEN strftime(min(CASE WHEN day = f THEN at_ END), {_T}) END AS first_at FROM y GROUP BY key HAVING NOT bool_or(day IS NULL)""",
    "followup_list": f"""{_SEEN}, se AS (SELECT hf_repo_id, string_agg(event_type, ',' ORDER BY rank) AS sources FROM (SELECT DISTINCT hf_repo_id, event_type, rank FROM ok) GROUP BY 1)
        SELECT hf_repo_id, 'observed' AS what, sources FROM se UNION ALL SELECT hf_repo_id, 'to_poll', '' FROM em WHERE hf_repo_id NOT IN (SELECT hf_repo_id FROM se) AND hf_repo_id NOT IN (SELECT hf_repo_id FROM fd WHERE http_status = 404)""",
    "poll_coverage": f"""{_SEEN}, se AS (SELECT hf_repo_id, arg_min(event_type, rank) AS leg FROM ok GROUP BY 1), fl AS (SELECT hf_repo_id, min('gone_' || event_type) AS reason FROM fd WHERE http_status = 404 AND hf_repo_id NOT IN (SELECT hf_repo_id FROM se) GROUP BY 1), fr AS (SELECT reason, count(*) AS n FROM fl GROUP BY 1),
        q AS (SELECT (SELECT count(*) FROM em) AS a, (SELECT count(*) FROM se) AS s, (SELECT count(*) FROM fl) AS f)
        SELECT a AS n_members, s + f AS attempted, s AS successful, (SELECT count(*) FROM se WHERE leg IN ('purchase', 'signup')) AS reused, a - s - f AS n_deferred, coalesce((SELECT string_agg(reason || '=' || n, ',' ORDER BY reason || '=' || n) FROM fr), '') AS failed_by_reason, CASE WHEN a - s - f > 0 THEN 'budget=' || (a - s - f) ELSE '' END AS deferred_by_reason, round(s / a, 6) AS coverage FROM q""",
    "identity_reviews": f"{_MEM}, {_FOUND} SELECT strftime(day, '%Y-%m-%d') AS day, g AS selection_group, hf_repo_id AS requested_id, id AS response_id, http_status, 'pending_review' AS decision, count(*) AS n FROM f JOIN m USING (hf_repo_id) WHERE id <> hf_repo_id GROUP BY ALL",
    "response_verdicts": f"WITH {_FOUND} SELECT event_id, {_REASON} AS reason, http_status = 404 OR (http_status = 200 AND id <> hf_repo_id AND event_id % 2 = 0) AS terminal FROM f",
    "wanted_ids": "SELECT DISTINCT lower(p_brand) || '/' || p_size AS hugging_face_id FROM part WHERE p_size > 25",
    "eligibility": """WITH c AS (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN '.bad/' || c_custkey WHEN c_custkey % 7 = 0 THEN 'a b/' || c_custkey WHEN c_custkey % 3 = 0 THEN 'solo.' || c_custkey ELSE 'o-1/m_' || c_custkey || '.v2' END AS id FROM customer),
        v AS (SELECT *, regexp_full_match(id, '[A-Za-z0-9_-]+(\\.[A-Za-z0-9_-]+)*(/[A-Za-z0-9_-]+(\\.[A-Za-z0-9_-]+)*)?') AS ok, c_acctbal >= 0 AND c_custkey % 4 <> 0 AS cn FROM c)
        SELECT c_custkey, ok AS valid_id, cn AS valid_counts, ok AND cn AND c_custkey % 10 <> 3 AS eligible FROM v""",
    "observation_labels": f"""{EVENTS_SQL}, b AS (SELECT user_id, min(day) AS f, min(CASE WHEN event_type = 'purchase' THEN day END) AS bought FROM e GROUP BY 1), o AS (SELECT o_custkey AS user_id, min(DATE '2024-01-01' + day(o_orderdate)::INT - 1) AS od FROM orders GROUP BY 1)
        SELECT user_id, CASE WHEN od IS NULL THEN 'not_observed' WHEN od < f THEN 'before_hf' WHEN od = f THEN 'same_day' ELSE 'after_hf' END AS "order", coalesce(bought = f, false) AS censored_purchase, coalesce(od <= f, false) AS censored_order, strftime(coalesce(bought, f), '%Y-%m-%d') AS observed FROM b LEFT JOIN o USING (user_id)""",
    "existence_flags": f"WITH {_LINK} SELECT * FROM l",
    "coverage_counts": f"WITH {_LINK}, c AS (SELECT count(*) AS a, count_if(sold) AS s, count_if(returned) AS r, count_if(urgent) AS u FROM l) SELECT 'entities' AS measure, a AS n, 1.0::DOUBLE AS rate FROM c UNION ALL SELECT 'sold', s, round(s / a, 6) FROM c UNION ALL SELECT 'returned', r, round(r / a, 6) FROM c UNION ALL SELECT 'urgent', u, round(u / a, 6) FROM c",
    "status_histogram": "SELECT 'lookup' AS field, coalesce(nullif(l_returnflag, 'N'), 'unknown') AS status, count(*) AS n FROM lineitem GROUP BY 2 UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem GROUP BY 2",
    "reference_spellings": r"""WITH n AS (SELECT doc_id, '23' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '.' || lpad((doc_id % 50 + 1)::VARCHAR, 5, '0') AS num FROM documents),
        t AS (SELECT doc_id, num, CASE doc_id % 5 WHEN 0 THEN 'arXiv:' || num || 'v1' WHEN 1 THEN 'x' || num WHEN 2 THEN 'hep-th/' || lpad((doc_id % 40)::VARCHAR, 7, '0') || 'V2' ELSE num END AS raw FROM n),
        p AS (SELECT *, regexp_replace(trim(raw), '^(arXiv:|arxiv:)', '') AS bare FROM t), i AS (SELECT *, CASE WHEN regexp_full_match(bare, '([a-z-]+(\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(v\d+)?', 'i') THEN regexp_replace(bare, '[vV]\d+$', '') END AS id FROM p),
        w AS (SELECT DISTINCT CASE WHEN doc_id % 3 = 0 THEN id ELSE num END AS id FROM i), f AS (SELECT id, string_agg(DISTINCT raw, ',' ORDER BY raw) AS s FROM i WHERE id IS NOT NULL GROUP BY 1)
        SELECT w.id, coalesce(s, w.id) AS spellings FROM w LEFT JOIN f USING (id) WHERE w.id IS NOT NULL UNION ALL SELECT DISTINCT raw, 'malformed' FROM i WHERE id IS NULL""",
    "missing_metrics": f"""{EVENTS_SQL}, g AS (SELECT user_id, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY))::DATE AS day FROM (SELECT DISTINCT user_id FROM e)), m AS (SELECT user_id, day, unnest(['purchase', 'view']) AS metric FROM g)
        SELECT user_id, strftime(day, '%Y-%m-%d') AS day, metric FROM m WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = m.user_id AND e.day = m.day AND e.event_type = m.metric)""",
    "json_leaves": """SELECT p_partkey, 'a.b' AS path, p_size::VARCHAR AS value FROM part UNION ALL SELECT p_partkey, 'a.c', to_json(p_brand)::VARCHAR FROM part WHERE p_size > 20 UNION ALL SELECT p_partkey, 'a.d.e', to_json([p_type, p_brand])::VARCHAR FROM part UNION ALL SELECT p_partkey, 'f', (p_size > 10)::VARCHAR FROM part""",
    "usage_rules": """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS name, sum(o_totalprice) AS a FROM orders GROUP BY 1, 2), s AS (SELECT month, name, 100 * a / sum(a) OVER (PARTITION BY month) AS v FROM o), x AS (SELECT month, name, CASE WHEN month LIKE '%-07' AND name LIKE '2%' THEN -v ELSE v END AS v FROM s WHERE NOT (month LIKE '%-03' AND name LIKE '5%')),
        u AS (SELECT * FROM x UNION ALL SELECT * FROM x WHERE month LIKE '%-09' AND name LIKE '4%'), b AS (SELECT month, sum(v) AS t, bool_or(name LIKE '5%') AS other FROM u GROUP BY 1)
        SELECT month, 'duplicate_key' AS rule, count(*) AS n FROM (SELECT month, name FROM u GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1 UNION ALL SELECT month, 'invalid_value', count(*) FROM u WHERE v < 0 OR v > 100 GROUP BY 1
        UNION ALL SELECT month, 'sum_not_100', 1 FROM b WHERE abs(t - 100) > 0.05 UNION ALL SELECT month, 'no_remainder', 1 FROM b WHERE NOT other""",
    "series_rules": f"""{_SER}, ps AS (SELECT DISTINCT position, day FROM s) SELECT 's' AS series, 'duplicate_day' AS rule, strftime(day, '%Y-%m-%d') AS detail FROM ps GROUP BY day HAVING count(*) > 1
        UNION ALL SELECT 's', 'unequal_length', name FROM s GROUP BY name HAVING count(*) <> (SELECT count(*) FROM ps)
        UNION ALL SELECT 's', 'sum_not_100', strftime(day, '%Y-%m-%d') FROM s WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-02-03' GROUP BY s.day HAVING abs(sum(share) - 100) > 0.001
        UNION ALL SELECT 's', 'missing_day', strftime(g, '%Y-%m-%d') FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-02-03', INTERVAL 1 DAY))::DATE AS g) WHERE g NOT IN (SELECT day FROM s)""",
    "series_quality": f"{_SER} SELECT 's' AS series, count(DISTINCT day) FILTER (day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20') AS n_days, count_if(day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20') AS n_rows, count(DISTINCT name) FILTER (day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20') AS n_names, count(DISTINCT position) FILTER (NOT day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20') AS n_excluded FROM s",
    "lifecycle_rules": f"""{_LIFE}, z AS (SELECT l.*, coalesce(rt.n, 0) AS n FROM l LEFT JOIN rt USING (user_id)), u AS (
        SELECT user_id::VARCHAR AS subject, 'created_after_first_seen' AS rule FROM z WHERE age < 0 UNION ALL SELECT user_id::VARCHAR, 'route_count' FROM z WHERE rc <> n UNION ALL SELECT user_id::VARCHAR, 'negative_days_to_large' FROM z WHERE lag < 0
        UNION ALL SELECT user_id::VARCHAR, 'eligibility_7' FROM z WHERE el <> (fu >= 8) UNION ALL SELECT user_id::VARCHAR, 'immature_milestone_7' FROM z WHERE NOT el AND ms IS NOT NULL
        UNION ALL SELECT user_id::VARCHAR, 'id_not_unique' FROM l GROUP BY user_id HAVING count(*) > 1 UNION ALL SELECT user_id || '|signup', 'event_kind_not_unique' FROM e WHERE event_type = 'signup' GROUP BY user_id HAVING count(*) > 1) SELECT subject, rule, count(*) AS n FROM u GROUP BY ALL""",
    "registry_rules": f"""{_MEM}, x AS (SELECT CASE WHEN n % 8 = 0 THEN '-/ ' || hf_repo_id ELSE hf_repo_id END AS subject, CASE WHEN n % 100 = 1 THEN 'no id' ELSE 'c1' END AS cohort_id, n FROM m), y AS (SELECT * FROM x UNION ALL SELECT * FROM x WHERE n % 25 = 0)
        SELECT cohort_id, subject, 'cohort_id' AS rule FROM y WHERE n % 100 = 1 UNION ALL SELECT cohort_id, subject, 'member_id' FROM y WHERE n % 8 = 0 UNION ALL SELECT cohort_id, subject, 'enrolled_at' FROM y WHERE n % 9 = 0 UNION ALL SELECT cohort_id, subject, 'duplicate_member' FROM y GROUP BY 1, 2 HAVING count(*) > 1""",
    "frozen_inputs": f"""WITH a AS ({_POP.format('customer')}), b AS ({_POP.format("(SELECT * FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND c_custkey % 50 = 0) AND c_mktsegment <> 'MACHINERY')")}), j AS (SELECT c_mktsegment, a.n AS n1, b.n AS n2, a.digest AS d1, b.digest AS d2 FROM a FULL JOIN b USING (c_mktsegment))
        SELECT c_mktsegment, 'n' AS field FROM j WHERE n1 IS DISTINCT FROM n2 UNION ALL SELECT c_mktsegment, 'digest' FROM j WHERE d1 IS DISTINCT FROM d2""",
    "stale_index": """WITH a AS (SELECT doc_id, sha256(text) AS sum FROM documents), b AS (SELECT doc_id, sha256(CASE WHEN doc_id % 19 = 0 THEN text || '!' ELSE text END) AS sum FROM documents WHERE doc_id % 23 <> 0)
        SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "reconciliation": f"""{EVENTS_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rank, ts, event_id) AS n FROM e), s AS (SELECT user_id, count(*) AS n_days, arg_max(value, day) FILTER (value IS NOT NULL) AS v FROM c WHERE n = 1 GROUP BY 1)
        SELECT user_id, 'missing_in_result' AS problem FROM s WHERE user_id % 21 = 0 UNION ALL SELECT user_id, 'differs_n_days' FROM s WHERE user_id % 21 <> 0 AND user_id % 10 = 0 UNION ALL SELECT user_id, 'differs_last_value' FROM s WHERE user_id % 21 <> 0 AND user_id % 15 = 0 AND v IS NOT NULL UNION ALL SELECT -user_id - 1, 'only_in_result' FROM s WHERE user_id % 33 = 0""",
    "extract_profile": f"""{EVENTS_SQL}, k AS (SELECT day, event_type, user_id, count(*) AS n FROM e GROUP BY ALL) SELECT strftime(day, '%Y-%m-%d') AS day, event_type, sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_repeats FROM k GROUP BY k.day, event_type
        UNION ALL SELECT strftime(day, '%Y-%m-%d'), 'all', count(*), count(DISTINCT user_id), 0 FROM e GROUP BY e.day""",
    "research_summary": f"""{EVENTS_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rank, ts, event_id) AS i FROM e), v AS (SELECT user_id, day, event_type, CASE WHEN value > 10 THEN value END AS value, props FROM c WHERE i = 1),
        p AS (SELECT user_id, count(*) AS n FROM v GROUP BY 1), g AS (SELECT date_diff('day', lag(v.day) OVER (PARTITION BY user_id ORDER BY v.day), v.day) AS gap FROM v)
        SELECT 'observations' AS measure, n::VARCHAR AS label, count(*) AS n FROM p GROUP BY p.n UNION ALL SELECT 'source', event_type, count(*) FROM v GROUP BY 2 UNION ALL SELECT 'gap_days', gap::VARCHAR, count(*) FROM g WHERE gap IS NOT NULL GROUP BY gap
        UNION ALL SELECT 'cutoff', CASE WHEN day <= DATE '2024-01-20' THEN 'overlap' ELSE 'extension' END, count(*) FROM v GROUP BY 2 UNION ALL SELECT 'missing', 'value', count_if(value IS NULL) FROM v UNION ALL SELECT 'missing', 'props', count_if(props IS NULL) FROM v""",
    "latest_request": "SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS day FROM orders WHERE o_orderpriority NOT LIKE '1%' GROUP BY 1",
}
