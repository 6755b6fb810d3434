"""The query of the event ledger: a user is a deployment, an event an observation of it in its source's snapshot of a day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as ledger
from ..operators import identity
from ..session import written
from .binding import EVENTS_SQL, day_text, events

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _target():
    return F.concat(F.lit("r/"), F.floor(F.col("value") / 34))


def _facts(spark, d):
    """Prices, contexts and capabilities follow the event's value and type; some lack an instant, a day, a price or a presence."""
    i, step = F.col("event_id"), lambda n: F.floor(F.col("value") / n).cast("string")
    source = F.concat(F.lit("s"), (i % 2).cast("string"))
    price = F.map_filter(F.create_map(F.lit("completion"), F.when(i % 5 != 0, step(50)), F.lit("prompt"), step(20)), lambda k, v: v.isNotNull())
    context = F.map_filter(F.create_map(F.lit("length"), F.when(i % 11 != 0, step(25))), lambda k, v: v.isNotNull())
    return events(spark, d).select(
        F.lpad(i.cast("string"), 12, "0").alias("observation_id"), F.col("user_id").alias("deployment_key"), F.concat(F.lit("p"), F.col("user_id") % 7).alias("provider"), F.concat(F.lit("m"), "user_id").alias("provider_model_id"),
        source.alias("source"), F.lit("all").alias("scope"), F.concat(source, F.lit(":"), F.date_format("day", "yyyy-MM-dd")).alias("snapshot_id"), F.when(i % 29 != 0, "PRESENT").otherwise("UNKNOWN").alias("presence_state"),
        F.when(i % 23 != 0, F.date_trunc("hour", "ts")).cast("timestamp_ntz").alias("observed_at"), F.when(i % 3 == 0, "second").otherwise("fractional_seconds_3").alias("observed_precision"), F.when(i % 997 != 0, F.col("day")).alias("observation_date"),
        price.alias("price"), F.when(F.col("event_type").isin("view", "click"), "usd").otherwise("eur").alias("price_terms"), context.alias("context"), F.create_map(F.lit("tier"), F.col("event_type")).alias("capabilities"),
        F.when(F.col("event_type").isin("purchase", "view"), _target()).alias("target"),
    )


def _reviews(spark, d):
    i = F.col("event_id")
    method = F.when(F.col("event_type") == "click", identity.METHODS[1]).when(F.col("event_type") == "signup", identity.METHODS[3]).when(F.col("event_type") == "error", identity.METHODS[4])
    return events(spark, d).where(method.isNotNull()).select(
        F.lpad(i.cast("string"), 12, "0").alias("observation_id"), method.alias("method"), F.when(i % 11 != 0, _target()).alias("target"), F.when(F.col("event_type") == "signup", F.concat(F.lit("c"), F.floor(F.col("value") / 50))).alias("canonical"),
        F.when(i % 3 == 0, "pending").otherwise("approved").alias("review_status"), F.when(i % 13 != 0, F.date_trunc("hour", "ts")).cast("timestamp_ntz").alias("available_at"),
    )


def lifecycle_ledger(spark, d):
    facts = _facts(spark, d)
    # both are read by several parts of the ledger, and their hashes and windows are most of its work
    found = written(identity.candidates(facts, _reviews(spark, d)), "candidates")
    out = ledger.ledger(facts, written(identity.decisions(found), "decisions"), found, F.lit("2024-12-31T00:00:00Z").cast("timestamp"))
    text = lambda c: F.date_format(c, MICROS).alias(c)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return out.select(
        "event_id", "event_type", "deployment_key", "provider", "provider_model_id", "canonical_model_id", "hf_repo_id", "identity_state", "identity_decision_id", text("observed_at"), day_text("observation_date"), "observed_precision", "observed_basis", "field", joined("changed_paths"),
        text("previous_observed_at"), "previous_value", "new_value", joined("previous_observation_ids"), joined("observation_ids"), joined("previous_snapshot_ids"), joined("snapshot_ids"), "previous_identity_decision_id", "left_censored", F.size("source_evidence").alias("n_evidence"),
    )


QUERIES = {"lifecycle_ledger": lifecycle_ledger}

_M = "'%Y-%m-%dT%H:%M:%S.%f'"
_CHANGE = """
SELECT '{kind}' AS event_type, k, '{f}' AS field, {paths} AS paths, bat AS at_, bday AS day, prs[1].{raw} AS pv, rs[1].{raw} AS nv, prs, rs FROM l WHERE ok_{f} AND pok_{f} AND len({paths}) > 0{more}"""
_LEDGER = f"""{EVENTS_SQL}, c0 AS (SELECT lpad(event_id::VARCHAR, 12, '0') AS o, user_id AS k, event_type IN ('purchase', 'view') AS dc, event_id AS i, event_type AS ty, CASE WHEN event_type IN ('purchase', 'view') THEN CASE WHEN event_id % 23 <> 0 THEN date_trunc('hour', ts) END WHEN event_id % 13 <> 0 THEN date_trunc('hour', ts) END::TIMESTAMP AS at_,
  CASE WHEN event_type IN ('purchase', 'view') OR event_id % 11 <> 0 THEN 'r/' || floor(value / 34)::INT END AS t, CASE WHEN event_type = 'signup' THEN 'c' || floor(value / 50)::INT END AS c,
  CASE WHEN event_type IN ('purchase', 'view') THEN 'explicit_provider_mapping' WHEN event_type = 'click' THEN 'exact_external_identifier' WHEN event_type = 'signup' THEN 'curated' ELSE 'fuzzy' END AS method FROM e),
c1 AS (SELECT *, sha256(to_json([o, method, t, c, strftime(at_, {_M})])::VARCHAR) AS id, method <> 'fuzzy' AND (dc OR i % 3 <> 0) AS ok FROM c0 WHERE at_ IS NOT NULL),
i AS (SELECT k, at_, {', '.join(f"list(DISTINCT {{'t': t, 'c': c, 'i': id}}) FILTER (ok AND method = '{m}') AS {n}" for n, m in (("m1", "explicit_provider_mapping"), ("m2", "exact_external_identifier"), ("m4", "curated")))} FROM c1 GROUP BY k, at_),
h AS (SELECT k, at_, last_value(m1 IGNORE NULLS) OVER w AS m1, last_value(m2 IGNORE NULLS) OVER w AS m2, last_value(m4 IGNORE NULLS) OVER w AS m4 FROM i WINDOW w AS (PARTITION BY k ORDER BY at_ ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, coalesce(m1, m2, m4) AS held, list_distinct(list_transform(coalesce(m1, m2, m4), lambda x: {{'t': x.t, 'c': x.c}})) AS prs FROM h),
q AS (SELECT *, list_filter(coalesce(m4, []), lambda x: x.c IS NOT NULL AND x.t IS NOT DISTINCT FROM prs[1].t) AS rv FROM g),
d0 AS (SELECT k, at_ AS vf, CASE WHEN held IS NULL THEN 'unresolved' WHEN len(prs) = 1 THEN 'resolved' ELSE 'ambiguous' END AS state, CASE WHEN len(prs) = 1 THEN prs[1].t END AS target,
  CASE WHEN len(prs) = 1 AND len(list_distinct(list_transform(rv, lambda x: x.c))) = 1 THEN rv[1].c END AS canonical, list_sort(list_distinct(list_transform(coalesce(held, []), lambda x: x.i) || CASE WHEN len(prs) = 1 THEN list_transform(rv, lambda x: x.i) ELSE [] END)) AS ids,
  CASE WHEN len(prs) > 1 THEN list_sort(list_distinct(list_filter(list_transform(held, lambda x: x.t), lambda x: x IS NOT NULL))) ELSE []::VARCHAR[] END AS wav FROM q),
d1 AS (SELECT *, sha256(to_json([k::VARCHAR, strftime(vf, {_M}), state, target, canonical, to_json(ids)::VARCHAR])::VARCHAR) AS did, '{{"state":"' || state || '"' || coalesce(',"target":"' || target || '"', '') || ',"wavering":' || to_json(wav)::VARCHAR || '}}' AS val FROM d0),
d2 AS (SELECT *, min(CASE WHEN target IS NOT NULL THEN vf END) OVER (PARTITION BY k) AS linked, lag(val) OVER w AS pval, lag(did) OVER w AS pdid, lag(vf) OVER w AS pvf, lag(ids) OVER w AS pids FROM d1 WINDOW w AS (PARTITION BY k ORDER BY vf)),
f AS (SELECT lpad(event_id::VARCHAR, 12, '0') AS o, user_id AS k, 's' || (event_id % 2) AS src, 's' || (event_id % 2) || ':' || strftime(day, '%Y-%m-%d') AS s, CASE WHEN event_id % 23 <> 0 THEN date_trunc('hour', ts)::TIMESTAMP END AS a, CASE WHEN event_id % 3 = 0 THEN 'second' ELSE 'fractional_seconds_3' END AS p, CASE WHEN event_id % 997 <> 0 THEN day END AS day, event_id % 29 <> 0 AS there,
  floor(value / 20)::INT AS pr, CASE WHEN event_id % 5 <> 0 THEN floor(value / 50)::INT END AS co, CASE WHEN event_type IN ('view', 'click') THEN 'usd' ELSE 'eur' END AS terms, CASE WHEN event_id % 11 <> 0 THEN floor(value / 25)::INT END AS cx, event_type AS tier FROM e),
fx AS (SELECT *, '{{' || CASE WHEN co IS NOT NULL THEN '"completion":"' || co || '",' ELSE '' END || '"prompt":"' || pr || '"}}' AS price, '{{"length":"' || cx || '"}}' AS context, '{{"tier":"' || tier || '"}}' AS capabilities FROM f),
ev AS (SELECT * FROM fx WHERE there), b AS (SELECT k, src, s, bool_or(a IS NULL) AS untimed, max(a) AS mx, max(day) AS md FROM ev GROUP BY ALL),
fb AS (SELECT ev.*, untimed, CASE WHEN untimed THEN md ELSE mx::DATE END AS bday, CASE WHEN NOT untimed THEN mx END AS bat FROM ev JOIN b USING (k, src, s)),
p0 AS (SELECT k, src, bday, bat, bool_or(untimed) AS u, count(DISTINCT price) = 1 AS v_price, bool_and(cx IS NOT NULL) AND count(DISTINCT cx) = 1 AS v_context, count(DISTINCT tier) = 1 AS v_capabilities, list({{'o': o, 's': s, 'a': a, 'p': p, 'price': price, 'context': context, 'capabilities': capabilities, 'pr': pr, 'co': co, 'terms': terms}} ORDER BY o) AS rs FROM fb GROUP BY k, src, bday, bat),
p1 AS (SELECT *, bool_or(u) OVER (PARTITION BY k, src, bday) AS bar, bool_or(u AND bday IS NULL) OVER (PARTITION BY k, src) AS lost FROM p0), p2 AS (SELECT *, {', '.join(f"NOT bar AND v_{x} AS ok_{x}" for x in ledger.FIELDS)} FROM p1 WHERE NOT lost),
l AS (SELECT *, {', '.join(f"lag(ok_{x}) OVER w AS pok_{x}" for x in ledger.FIELDS)}, lag(rs) OVER w AS prs FROM p2 WINDOW w AS (PARTITION BY k, src ORDER BY bday, bat NULLS FIRST)),
ls AS (SELECT k, min(day) AS d FROM ev GROUP BY k HAVING bool_and(day IS NOT NULL)), lt AS (SELECT ls.k, d, CASE WHEN bool_and(a IS NOT NULL) THEN min(a) END AS a0 FROM ls JOIN ev ON ev.k = ls.k AND ev.day = d GROUP BY ALL),
iv AS (SELECT d2.*, vf = linked AS first FROM d2 WHERE vf = linked OR (vf > linked AND val IS DISTINCT FROM pval)),
ic AS (SELECT k, vf, 'c' AS side, unnest(ids) AS id FROM iv UNION ALL SELECT k, vf, 'p', unnest(pids) FROM iv WHERE NOT first),
ie AS (SELECT ic.k, ic.vf, list(DISTINCT {{'o': fx.o, 's': s, 'a': a}}) FILTER (side = 'c') AS rs, list(DISTINCT {{'o': fx.o, 's': s, 'a': a}}) FILTER (side = 'p') AS prs FROM ic JOIN c1 ON c1.id = ic.id JOIN fx ON fx.o = c1.o GROUP BY 1, 2),
w0 AS ({_CHANGE.format(kind='PRICE_CHANGED', f='price', raw='price', paths="list_filter([CASE WHEN prs[1].co <> rs[1].co THEN 'completion' END, CASE WHEN prs[1].pr <> rs[1].pr THEN 'prompt' END], lambda x: x IS NOT NULL)", more=' AND prs[1].terms = rs[1].terms')}
UNION ALL {_CHANGE.format(kind='CONTEXT_CHANGED', f='context', raw='context', paths="CASE WHEN prs[1].context <> rs[1].context THEN ['length'] ELSE [] END", more='')}
UNION ALL {_CHANGE.format(kind='CAPABILITY_CHANGED', f='capabilities', raw='capabilities', paths="CASE WHEN prs[1].capabilities <> rs[1].capabilities THEN ['tier'] ELSE [] END", more='')}
UNION ALL SELECT 'PROVIDER_LISTED', lt.k, 'presence_state', []::VARCHAR[], a0, d, NULL, 'PRESENT', []::STRUCT(o VARCHAR, s VARCHAR, a TIMESTAMP, p VARCHAR, price VARCHAR, context VARCHAR, capabilities VARCHAR, pr INT, co INT, terms VARCHAR)[], list({{'o': o, 's': s, 'a': a, 'p': p, 'price': price, 'context': context, 'capabilities': capabilities, 'pr': pr, 'co': co, 'terms': terms}} ORDER BY o)
  FROM lt JOIN ev ON ev.k = lt.k AND ev.day = d AND (a0 IS NULL OR a = a0) GROUP BY lt.k, a0, d),
w1 AS (SELECT w0.*, state, target, canonical, did FROM w0 ASOF LEFT JOIN d1 ON d1.k = w0.k AND w0.at_ >= d1.vf),
w2 AS (SELECT event_type, k, field, paths, at_, day, pv, nv, list_transform(prs, lambda x: x.o) AS pids, list_transform(rs, lambda x: x.o) AS ids, list_sort(list_distinct(list_transform(prs, lambda x: x.s))) AS ps, list_sort(list_distinct(list_transform(rs, lambda x: x.s))) AS ss, list_max(list_transform(prs, lambda x: x.a)) AS pat,
    coalesce(list_filter(rs, lambda x: x.a = at_)[1].p, 'day') AS prec, CASE WHEN at_ IS NULL THEN 'source manifest day' ELSE 'positive source capture' END AS basis, state, target, canonical, did, NULL AS pdid, NULL AS cdid FROM w1
  UNION ALL SELECT CASE WHEN first THEN 'HF_IDENTITY_LINKED' ELSE 'HF_IDENTITY_REVISED' END, iv.k, 'hf_identity', []::VARCHAR[], iv.vf, iv.vf::DATE, CASE WHEN NOT first THEN pval END, val, list_sort(list_transform(coalesce(prs, []), lambda x: x.o)), list_sort(list_transform(coalesce(rs, []), lambda x: x.o)), list_sort(list_distinct(list_transform(coalesce(prs, []), lambda x: x.s))), list_sort(list_distinct(list_transform(coalesce(rs, []), lambda x: x.s))),
    CASE WHEN NOT first THEN pvf END, CASE WHEN rs IS NULL THEN 'unknown' ELSE 'second' END, 'identity_decision.valid_from', state, target, canonical, did, CASE WHEN NOT first THEN pdid END, did FROM iv LEFT JOIN ie ON ie.k = iv.k AND ie.vf = iv.vf)"""

ORACLES = {
    "lifecycle_ledger": f"""{_LEDGER} SELECT sha256(to_json(['1', event_type, k::VARCHAR, field, to_json(paths)::VARCHAR, pv, nv, to_json(pids)::VARCHAR, to_json(ids)::VARCHAR, strftime(at_, {_M}), strftime(day, '%Y-%m-%d'), pdid, cdid])::VARCHAR) AS event_id, event_type, k AS deployment_key, 'p' || (k % 7) AS provider, 'm' || k AS provider_model_id,
        canonical AS canonical_model_id, target AS hf_repo_id, coalesce(state, 'unknown') AS identity_state, did AS identity_decision_id, strftime(at_, {_M}) AS observed_at, strftime(day, '%Y-%m-%d') AS observation_date, prec AS observed_precision, basis AS observed_basis, field, coalesce(array_to_string(paths, ','), '') AS changed_paths, strftime(pat, {_M}) AS previous_observed_at,
        pv AS previous_value, nv AS new_value, coalesce(array_to_string(pids, ','), '') AS previous_observation_ids, coalesce(array_to_string(ids, ','), '') AS observation_ids, coalesce(array_to_string(ps, ','), '') AS previous_snapshot_ids, coalesce(array_to_string(ss, ','), '') AS snapshot_ids, pdid AS previous_identity_decision_id,
        event_type = 'PROVIDER_LISTED' AS left_censored, len(pids) + len(ids) AS n_evidence FROM w2""",
}
