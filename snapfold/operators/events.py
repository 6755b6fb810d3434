"""The ledger of lifecycle events: what positive evidence says has happened to a deployment, and the evidence itself.

Absence is never an event. An event is listed (the first presence), changed (price, context or capabilities differ from the
batch right before) or about identity (linked, revised). Each names the observations of both sides, the decision on identity
that was in force, and has an id that binds all of it but not the time of the replay.

Batches are compared by fingerprints of fixed size in one pass over the facts; values and evidence are fetched only for the
batches that may hold an event.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import changed_keys, content_key
from .identity import INSTANT
from .temporal import as_of

VERSION = "1"
# The fields that are compared and the events of their changes.
FIELDS = {"price": "PRICE_CHANGED", "context": "CONTEXT_CHANGED", "capabilities": "CAPABILITY_CHANGED"}
SERIES = ["deployment_key", "source", "scope"]
EVIDENCE = "array<struct<observation_id:string,snapshot_id:string,observed_at:timestamp_ntz,observed_precision:string>>"


def _present(facts: DataFrame) -> DataFrame:
    return facts.where("presence_state = 'PRESENT' and deployment_key is not null").withColumns({"source": F.coalesce("source", F.lit("")), "scope": F.coalesce("scope", F.lit(""))})


def _evidence() -> Column:
    return F.struct(F.col("observation_id").cast("string").alias("observation_id"), F.col("snapshot_id").cast("string").alias("snapshot_id"), F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "observed_precision")


def _batches(facts: DataFrame) -> DataFrame:
    """A row a series and snapshot: instant, day, and the least and largest fingerprint of each field's values."""
    marks = {}
    for f in FIELDS:
        entries = F.array_sort(F.map_entries(f))
        marks |= {f"_{f}_1": F.xxhash64(entries), f"_{f}_2": F.xxhash64(F.lit(2), entries), f"_{f}_none": F.coalesce(F.size(f) <= 0, F.lit(True))}
    rows = facts.select(*SERIES, "snapshot_id", "observed_at", "observation_date", *[c.alias(n) for n, c in marks.items()])
    sums = [F.bool_or(F.col("observed_at").isNull()).alias("untimed"), F.max("observed_at").alias("_at"), F.max("observation_date").alias("_day")]
    return rows.groupBy(*SERIES, "snapshot_id").agg(*sums, *_merged(marks, first=True))


def _merged(marks, first: bool = False) -> list[Column]:
    """Fingerprints of several rows, or of several batches, as one."""
    out = []
    for name in marks:
        if name.endswith("_none"):
            out.append(F.bool_or(name).alias(name))
        else:
            low, high = (name, name) if first else (f"{name}_low", f"{name}_high")
            out += [F.min(low).alias(f"{name}_low"), F.max(high).alias(f"{name}_high")]
    return out


def _candidates(batches: DataFrame) -> DataFrame:
    """(series, at, snapshots, previous, flags): batches that differ from the one right before in a field that both tell, with the snapshots of either.

    A batch with an untimed row makes its day a barrier: every batch of that day is cut off and none is compared across it. One
    without a day takes out its series. Each field has its own chain: rows that differ or tell nothing cut only theirs.
    """
    marks = [m for f in FIELDS for m in (f"_{f}_1", f"_{f}_2", f"_{f}_none")]
    points = batches.withColumns({"day": F.when(F.col("untimed"), F.col("_day")).otherwise(F.to_date("_at")), "at": F.when(~F.col("untimed"), F.col("_at"))})
    points = points.groupBy(*SERIES, "day", "at").agg(F.bool_or("untimed").alias("untimed"), F.collect_list(F.when(~F.col("untimed"), F.col("snapshot_id"))).alias("snapshots"), *_merged(marks))
    lost = F.bool_or(F.col("untimed") & F.col("day").isNull()).over(Window.partitionBy(*SERIES))
    points = points.withColumns({"_lost": lost, "_barrier": F.bool_or("untimed").over(Window.partitionBy(*SERIES, "day"))}).where("not _lost")
    for f in FIELDS:
        one = (F.col(f"_{f}_1_low") == F.col(f"_{f}_1_high")) & (F.col(f"_{f}_2_low") == F.col(f"_{f}_2_high"))
        points = points.withColumn(f"_{f}", F.when(~F.col("_barrier") & one & ~F.col(f"_{f}_none"), F.struct(F.col(f"_{f}_1_low").alias("a"), F.col(f"_{f}_2_low").alias("b"))))
    w = Window.partitionBy(*SERIES).orderBy("day", F.col("at").asc_nulls_first())
    before = points.withColumns({"previous": F.lag("snapshots").over(w), **{f"_before_{f}": F.lag(f"_{f}").over(w) for f in FIELDS}})
    flags = {f"is_{f}": F.coalesce(F.col(f"_{f}") != F.col(f"_before_{f}"), F.lit(False)) for f in FIELDS}
    return before.select(*SERIES, "at", "snapshots", "previous", *[c.alias(n) for n, c in flags.items()]).where(reduce(lambda a, b: a | b, [F.col(n) for n in flags]))


def changes(facts: DataFrame) -> DataFrame:
    """Changed fields between batches that follow each other, with the evidence of both sides.

    Only keys that both sides have are compared; prices only where ``price_terms`` (currency, unit, field) agree. Several values
    of a side are none; what is reported as old and new is that of the side's least observation.
    """
    known = _present(facts)
    found = _candidates(_batches(known))
    sides = found.withColumn("_side", F.explode(F.array(F.struct(F.lit("current").alias("name"), F.col("snapshots").alias("ids")), F.struct(F.lit("previous").alias("name"), F.col("previous").alias("ids")))))
    parts = sides.select(*SERIES, "at", *[f"is_{f}" for f in FIELDS], F.col("_side.name").alias("side"), F.explode("_side.ids").alias("snapshot_id"))
    rows = known.join(parts, [*SERIES, "snapshot_id"])
    of = lambda side, c: F.when(F.col("side") == side, c)
    told = F.struct("provider", "provider_model_id", *FIELDS, *[F.col(f"{f}_raw") if f"{f}_raw" in facts.columns else F.to_json(f).alias(f"{f}_raw") for f in FIELDS], *([F.col("price_terms")] if "price_terms" in facts.columns else [F.lit("").alias("price_terms")]))
    both = rows.groupBy(*SERIES, "at", *[f"is_{f}" for f in FIELDS]).agg(
        *[F.array_sort(F.collect_list(of(s, _evidence()))).alias(s) for s in ("previous", "current")],
        *[F.min_by(told, of(s, F.col("observation_id"))).alias(f"_{s}") for s in ("previous", "current")],
    )
    each = []
    for f, kind in FIELDS.items():
        same = F.col("_previous.price_terms").eqNullSafe(F.col("_current.price_terms")) if f == "price" else F.lit(True)
        paths = F.when(F.col(f"is_{f}") & same, changed_keys(F.col(f"_previous.{f}"), F.col(f"_current.{f}")))
        each.append(F.struct(F.lit(kind).alias("event_type"), F.lit(f).alias("field"), paths.alias("changed_paths"), F.col(f"_previous.{f}_raw").alias("previous_value"), F.col(f"_current.{f}_raw").alias("new_value")))
    out = both.withColumn("e", F.explode(F.array(*each))).where("size(e.changed_paths) > 0")
    return out.select("e.event_type", "deployment_key", "_current.provider", "_current.provider_model_id", "e.field", "e.changed_paths", F.col("at").cast("timestamp_ntz").alias("at"), F.to_date("at").alias("day"), "e.previous_value", "e.new_value", "previous", "current")


def listings(facts: DataFrame) -> DataFrame:
    """The first presence of each deployment: the earliest observations of its first day, or all of that day if one has no instant.

    A deployment with an observation of no day has none. It may have been there before, so the event is left-censored.
    """
    known = _present(facts)
    days = known.groupBy("deployment_key", "observation_date").agg(F.bool_or(F.col("observed_at").isNull()).alias("untimed"), F.min("observed_at").alias("_at"))
    first = days.groupBy("deployment_key").agg(F.bool_or(F.col("observation_date").isNull()).alias("_undated"), F.min(F.struct("observation_date", "untimed", "_at")).alias("f")).where("not _undated")
    first = first.select("deployment_key", F.col("f.observation_date").alias("day"), F.when(~F.col("f.untimed"), F.col("f._at")).alias("at"))
    rows = known.join(first, "deployment_key").where((F.col("observation_date") == F.col("day")) & (F.col("at").isNull() | (F.col("observed_at") == F.col("at"))))
    out = rows.groupBy("deployment_key", "day", "at").agg(F.array_sort(F.collect_list(_evidence())).alias("current"), F.min_by(F.struct("provider", "provider_model_id"), "observation_id").alias("r"))
    none = F.lit(None).cast("string")
    return out.select(F.lit("PROVIDER_LISTED").alias("event_type"), "deployment_key", "r.provider", "r.provider_model_id", F.lit("presence_state").alias("field"), F.array().cast("array<string>").alias("changed_paths"), F.col("at").cast("timestamp_ntz").alias("at"), "day", none.alias("previous_value"), F.lit("PRESENT").alias("new_value"), F.array().cast(EVIDENCE).alias("previous"), "current")


def identities(facts: DataFrame, told: DataFrame, candidates: DataFrame) -> DataFrame:
    """Linked at the first decision with a target, revised whenever the belief differs from the one before it afterwards.

    The evidence are the observations that the decisions' candidates came from; the precision is that of the newest of them.
    """
    w = Window.partitionBy("deployment_key").orderBy("valid_from")
    wavering = F.when(F.col("state") == "ambiguous", F.col("targets")).otherwise(F.array().cast("array<string>"))
    value = F.to_json(F.struct("state", "target", wavering.alias("wavering")))
    rows = told.withColumn("_value", value).withColumns({"_linked": F.min(F.when(F.col("target").isNotNull(), F.col("valid_from"))).over(Window.partitionBy("deployment_key")), "_p": F.lag(F.struct("decision_id", "valid_from", F.col("_value").alias("value"), "candidate_ids")).over(w)})
    first = F.col("valid_from") == F.col("_linked")
    rows = rows.where(first | ((F.col("valid_from") > F.col("_linked")) & (F.col("_value") != F.col("_p.value"))))
    rows = rows.select("deployment_key", "valid_from", first.alias("first"), F.when(~first, F.col("_p")).alias("_p"), "decision_id", "_value", "candidate_ids", "state", "target", "canonical")
    cited = rows.select("deployment_key", "valid_from", F.explode(F.array(F.struct(F.lit("current").alias("name"), F.col("candidate_ids").alias("ids")), F.struct(F.lit("previous").alias("name"), F.col("_p.candidate_ids").alias("ids")))).alias("s"))
    cited = cited.select("deployment_key", "valid_from", F.col("s.name").alias("side"), F.explode("s.ids").alias("candidate_id"))
    precision = F.col("precision") if "precision" in candidates.columns else F.when(F.date_format("at", "SSSSSS") == "000000", "second").otherwise("fractional_seconds_6")
    known = candidates.select("candidate_id", "observation_id", F.col("at").alias("_available"), precision.alias("_precision"))
    seen = facts.select("observation_id", "snapshot_id", "observed_at", "observed_precision", "provider", "provider_model_id")
    sides = cited.join(known, "candidate_id").join(seen, "observation_id")
    of = lambda side, c: F.when(F.col("side") == side, c)
    least = F.struct("provider", "provider_model_id")
    found = sides.groupBy("deployment_key", "valid_from").agg(
        *[F.array_sort(F.collect_set(of(s, _evidence()))).alias(s) for s in ("previous", "current")],
        F.coalesce(F.min_by(least, of("current", F.col("observation_id"))), F.min_by(least, of("previous", F.col("observation_id")))).alias("r"),
        F.max_by(of("current", F.col("_precision")), of("current", F.struct("_available", "_precision"))).alias("precision"),
    )
    kind = F.when(F.col("first"), "HF_IDENTITY_LINKED").otherwise("HF_IDENTITY_REVISED")
    none = F.array().cast(EVIDENCE)
    out = rows.join(found, ["deployment_key", "valid_from"], "left")
    return out.select(
        kind.alias("event_type"), "deployment_key", "r.provider", "r.provider_model_id", F.lit("hf_identity").alias("field"), F.array().cast("array<string>").alias("changed_paths"), F.col("valid_from").cast("timestamp_ntz").alias("at"), F.to_date("valid_from").alias("day"),
        F.col("_p.value").alias("previous_value"), F.col("_value").alias("new_value"), F.coalesce("previous", none).alias("previous"), F.coalesce("current", none).alias("current"), F.coalesce("precision", F.lit("unknown")).alias("precision"),
        F.col("_p.decision_id").alias("previous_identity_decision_id"), F.col("_p.valid_from").cast("timestamp_ntz").alias("_previous_from"), F.struct("state", "target", "canonical", "decision_id").alias("_decision"),
    )


def ledger(facts: DataFrame, told: DataFrame, candidates: DataFrame, recorded_at: Column) -> DataFrame:
    """All events, each with its id, the identity believed at its instant, and its evidence.

    ``facts``: observation_id, deployment_key, provider, provider_model_id, source, scope, snapshot_id, presence_state, observed_at,
    observed_precision, observation_date and a map of comparable values a field (with ``<field>_raw``, the source's own text, and
    ``price_terms`` if there). Each of ``told`` and ``candidates`` is read more than once: written ones (``session.written``) are not computed again. ``told`` and ``candidates`` are those of ``identity``. An event later than ``recorded_at`` fails the job.
    """
    others = changes(facts).unionByName(listings(facts))
    of = F.struct(*[F.col(f"_b_{c}").alias(c) for c in ("state", "target", "canonical", "decision_id")])
    believed = told.select("deployment_key", "valid_from", F.lit(None).cast(told.schema["valid_from"].dataType).alias("valid_to"), *[F.col(c).alias(f"_b_{c}") for c in ("state", "target", "canonical", "decision_id")])
    others = as_of(others, believed, "deployment_key", "at", ["_b_state", "_b_target", "_b_canonical", "_b_decision_id"], most=None)
    timed = F.filter("current", lambda x: x["observed_at"] == F.col("at"))
    others = others.withColumn("_decision", of).withColumn("precision", F.coalesce(F.try_element_at(timed, F.lit(1))["observed_precision"], F.lit("day"))).drop("_b_state", "_b_target", "_b_canonical", "_b_decision_id")
    rows = others.unionByName(identities(facts, told, candidates), allowMissingColumns=True)
    ids = lambda side: F.transform(side, lambda x: x["observation_id"])
    snapshots = lambda side: F.array_sort(F.array_distinct(F.transform(side, lambda x: x["snapshot_id"])))
    about = F.col("field") == "hf_identity"
    rows = rows.withColumns({"previous_observation_ids": ids("previous"), "observation_ids": ids("current"), "_current_decision": F.when(about, F.col("_decision.decision_id"))})
    bound = [F.lit(VERSION), F.col("event_type"), F.col("deployment_key").cast("string"), F.col("field"), F.to_json("changed_paths"), F.col("previous_value"), F.col("new_value"), F.to_json("previous_observation_ids"), F.to_json("observation_ids"), F.date_format("at", INSTANT), F.date_format("day", "yyyy-MM-dd"), F.col("previous_identity_decision_id"), F.col("_current_decision")]
    late = F.coalesce(F.col("at").cast("timestamp") > recorded_at, F.lit(False))
    basis = F.when(about, "identity_decision.valid_from").when(F.col("at").isNotNull(), "positive source capture").otherwise("source manifest day")
    return rows.select(
        content_key(*bound).alias("event_id"), "event_type", "deployment_key", "provider", "provider_model_id", F.col("_decision.canonical").alias("canonical_model_id"), F.col("_decision.target").alias("hf_repo_id"), F.coalesce("_decision.state", F.lit("unknown")).alias("identity_state"), F.col("_decision.decision_id").alias("identity_decision_id"),
        F.when(late, F.raise_error(F.lit("cannot derive events from future observations")).cast("timestamp_ntz")).otherwise(F.col("at")).alias("observed_at"), F.col("day").alias("observation_date"), F.col("precision").alias("observed_precision"), basis.alias("observed_basis"), recorded_at.alias("recorded_at"), "field", "changed_paths",
        F.coalesce("_previous_from", F.array_max(F.transform("previous", lambda x: x["observed_at"]))).alias("previous_observed_at"), "previous_value", "new_value", "previous_observation_ids", "observation_ids", snapshots("previous").alias("previous_snapshot_ids"), snapshots("current").alias("snapshot_ids"),
        F.array_sort(F.concat("previous", "current")).alias("source_evidence"), "previous_identity_decision_id", (F.col("event_type") == "PROVIDER_LISTED").alias("left_censored"), F.lit(VERSION).alias("algorithm_version"),
    )
