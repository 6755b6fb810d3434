"""The event ledger: chains of each field, barriers, ids and evidence on small histories."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapfold.operators import events, identity

T = datetime(2024, 3, 1, 9)
SCHEMA = "observation_id string, deployment_key string, provider string, provider_model_id string, source string, scope string, snapshot_id string, presence_state string, observed_at timestamp_ntz, observed_precision string, observation_date date, price map<string,string>, price_terms string, context map<string,string>, capabilities map<string,string>, target string"


def row(i, at, price="1", context="8", cap="x", key="k", state="PRESENT", day=None, snapshot=None, target=None, terms="usd", **more):
    day = day if day is not None else at.date() if at else None
    prices = price if isinstance(price, dict) else {"prompt": price} if price else {}
    return (f"o{i}", key, "p", "m", "s", "all", snapshot or f"n{i}", state, at, "second", day, prices, terms, {"length": context} if context else {}, {"tier": cap} if cap else {}, target)


def ledger(spark, rows, reviews=(), recorded="2025-01-01T00:00:00Z"):
    facts = spark.createDataFrame(rows, SCHEMA)
    notes = spark.createDataFrame(list(reviews), "observation_id string, method string, target string, canonical string, review_status string, available_at timestamp_ntz")
    found = identity.candidates(facts, notes)
    return events.ledger(facts, identity.decisions(found), found, F.lit(recorded).cast("timestamp"))


def told(df, kind):
    return sorted((r["observed_at"].day if r["observed_at"] else None, r["previous_value"], r["new_value"], tuple(r["previous_observation_ids"]), tuple(r["observation_ids"])) for r in df.where(F.col("event_type") == kind).collect())


def test_each_field_has_its_own_chain(spark):
    days = [T + timedelta(i) for i in range(4)]
    got = ledger(spark, [row(0, days[0]), row(1, days[1], price="2", context=None), row(2, days[2], price=None, context="9"), row(3, days[3], price="3", context="10", cap="y")])
    assert told(got, "PRICE_CHANGED") == [(2, '{"prompt":"1"}', '{"prompt":"2"}', ("o0",), ("o1",))]
    assert told(got, "CONTEXT_CHANGED") == [(4, '{"length":"9"}', '{"length":"10"}', ("o2",), ("o3",))]
    assert told(got, "CAPABILITY_CHANGED") == [(4, '{"tier":"x"}', '{"tier":"y"}', ("o2",), ("o3",))]


def test_an_untimed_row_is_a_barrier_of_its_day(spark):
    rows = [row(0, T), row(1, None, price="2", day=date(2024, 3, 2)), row(2, T + timedelta(days=1), price="3"), row(3, T + timedelta(days=2), price="4"), row(4, T + timedelta(days=3), price="5")]
    assert [e[3:] for e in told(ledger(spark, rows), "PRICE_CHANGED")] == [(("o3",), ("o4",))]
    lost = [(*r[:10], None, *r[11:]) if r[0] == "o1" else r for r in rows]
    got = ledger(spark, lost)
    assert told(got, "PRICE_CHANGED") == [] and told(got, "PROVIDER_LISTED") == []


def test_rows_of_a_batch_must_agree(spark):
    a, b, c = T, T + timedelta(1), T + timedelta(2)
    got = ledger(spark, [row(0, a), row(1, b, price="2", snapshot="n"), row(2, b, price="3", snapshot="n"), row(3, c, price="4", context="9")])
    assert told(got, "PRICE_CHANGED") == []
    assert told(got, "CONTEXT_CHANGED") == [(3, '{"length":"8"}', '{"length":"9"}', ("o1", "o2"), ("o3",))]


def test_only_what_both_sides_have_in_the_same_terms(spark):
    a, b, c = T, T + timedelta(1), T + timedelta(2)
    got = ledger(spark, [row(0, a, price={"in": "1", "out": "1"}), row(1, b, price={"in": "1", "more": "2"}), row(2, c, price={"in": "2", "more": "3"}, terms="eur")])
    assert told(got, "PRICE_CHANGED") == []
    same = ledger(spark, [row(1, b, price={"in": "1", "more": "2"}), row(2, c, price={"in": "2", "more": "3"})])
    assert [r["changed_paths"] for r in same.where("event_type = 'PRICE_CHANGED'").collect()] == [["in", "more"]]


def test_listing_takes_the_earliest_rows_of_the_first_day(spark):
    got = ledger(spark, [row(0, T), row(1, T), row(2, T + timedelta(hours=1)), row(3, T, key="u"), row(4, None, key="u", day=T.date()), row(5, T, key="gone", state="ABSENT"), row(6, T, key=None)])
    listed = {r["deployment_key"]: r for r in got.where("event_type = 'PROVIDER_LISTED'").collect()}
    assert set(listed) == {"k", "u"} and listed["k"]["observation_ids"] == ["o0", "o1"] and listed["k"]["left_censored"]
    assert listed["u"]["observed_at"] is None and listed["u"]["observed_basis"] == "source manifest day" and listed["u"]["observed_precision"] == "day" and listed["u"]["observation_ids"] == ["o3", "o4"]


def test_identity_is_linked_once_and_then_revised(spark):
    days = [T + timedelta(i) for i in range(4)]
    rows = [row(0, days[0]), row(1, days[1], target="a/x"), row(2, days[2], target="a/y", price="2"), row(3, days[3], target="a/y")]
    got = ledger(spark, rows, [("o0", "curated", "a/x", "c1", "approved", days[1] + timedelta(hours=1))])
    about = sorted((r["observed_at"].day, r["event_type"], r["hf_repo_id"], tuple(r["observation_ids"]), r["previous_identity_decision_id"] is None) for r in got.where("field = 'hf_identity'").collect())
    assert about == [(2, "HF_IDENTITY_LINKED", "a/x", ("o1",), True), (3, "HF_IDENTITY_REVISED", "a/y", ("o2",), False)]
    price = got.where("event_type = 'PRICE_CHANGED'").first()
    assert price["hf_repo_id"] == "a/y" and price["identity_state"] == "resolved"
    assert got.where("event_type = 'PROVIDER_LISTED'").first()["identity_state"] == "unknown"


def test_ids_bind_evidence_and_not_the_replay(spark):
    rows = [row(i, T + timedelta(i), price=str(i), target="a/x") for i in range(5)]
    ids = lambda rs, **k: {r["event_id"] for r in ledger(spark, rs, **k).collect()}
    once = ids(rows)
    assert ids(rows[::-1], recorded="2026-01-01T00:00:00Z") == once and len(once) == 6
    assert len(ids([*rows[:4], row(9, T + timedelta(4), price="4", target="a/x")]) & once) == 5


def test_no_event_from_the_future(spark):
    with pytest.raises(Exception, match="future observations"):
        ledger(spark, [row(0, T)], recorded="2024-02-01T00:00:00Z").collect()


def test_the_ledger_reads_its_inputs_a_few_times(spark, sf_dir):
    """What its parts share is written once; each of them computed it anew from the facts, in 18 scans."""
    from snapfold.plans import events as plan

    tree = plan.lifecycle_ledger(spark, sf_dir)._jdf.queryExecution().optimizedPlan()
    leaves = tree.collectLeaves()
    assert leaves.size() <= 10
    assert sum("events.parquet" in f for f in plan.lifecycle_ledger(spark, sf_dir).inputFiles()) == 1


def test_instants_of_several_snapshots_are_one_side(spark):
    """All snapshots of an instant are evidence, and a batch after one without an instant has no side before it."""
    rows = [row(0, T, snapshot="a"), row(1, T, snapshot="b"), row(2, T + timedelta(1), price="2", snapshot="c"), row(3, T + timedelta(1), price="2", snapshot="d"), row(4, None, price="3", day=date(2024, 3, 3)), row(5, T + timedelta(3), price="4")]
    assert told(ledger(spark, rows), "PRICE_CHANGED") == [(2, '{"prompt":"1"}', '{"prompt":"2"}', ("o0", "o1"), ("o2", "o3"))]
