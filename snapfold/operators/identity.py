"""Identity from declared keys and reviewed evidence only: candidates, rules, merges, and what was believed at an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import content_key
from . import temporal

# Methods of evidence from the strongest to the weakest; the last never links.
METHODS = ["explicit_provider_mapping", "exact_external_identifier", "exact_deterministic_correspondence", "curated", "fuzzy"]
TARGET = r"^[^/\s]+/[^/\s]+$"
#: How an instant is spelled where ids bind it.
INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def merged(declared: Column, reviewed: Column, aggregate: Column) -> list[Column]:
    """(identity_status, target) of a fact from the targets that a catalogue declares and those that reviews give.

    ``declared`` may hold an empty text, a declaration of nothing, and texts that are no target. Beside a valid target either
    makes the declaration ambiguous. One target of both kinds together resolves the fact: ``source_explicit`` if it is declared,
    else ``curated``. A remainder is ``aggregate`` whatever is said of it.
    """
    none = F.array().cast("array<string>")
    said = F.array_distinct(F.coalesce(declared, none))
    valid = F.filter(said, lambda x: x.rlike(TARGET))
    open_ = (F.size(valid) > 0) & ((F.size(said) != 1) | (F.size(valid) != 1))
    targets = F.array_union(valid, F.coalesce(reviewed, none))
    one = (F.size(targets) == 1) & ~open_
    status = F.when(one, F.when(F.size(valid) > 0, "source_explicit").otherwise("curated")).when((F.size(targets) > 1) | open_, "ambiguous").otherwise("unresolved")
    return [F.when(aggregate, "aggregate").otherwise(status).alias("identity_status"), F.when(one & ~aggregate, F.element_at(targets, 1)).alias("target")]


def candidates(facts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Evidence for a target of each deployment: what sources declare at their instant, and reviews at their own, never backdated."""
    declared = facts.where("deployment_key is not null and coalesce(target, '') <> ''").select(
        "deployment_key", "observation_id", F.lit(METHODS[0]).alias("method"), "target", F.lit(None).cast("string").alias("canonical"), F.col("observed_at").alias("at"), F.lit(True).alias("approved")
    )
    reviewed = ledger.join(facts.select("observation_id", "deployment_key"), "observation_id").where("deployment_key is not null").select(
        "deployment_key", "observation_id", "method", "target", "canonical", F.col("available_at").alias("at"), (F.col("review_status") == "approved").alias("approved")
    )
    both = declared.unionByName(reviewed)
    named = [F.col(c).cast("string") for c in ("observation_id", "method", "target", "canonical")]
    both = both.withColumn("candidate_id", content_key(*named, F.date_format("at", INSTANT)))
    shaped = F.col("target").isNull() | F.col("target").rlike(TARGET)
    able = F.coalesce(F.col("approved"), F.lit(False)) & shaped & F.col("at").isNotNull() & (F.col("method") != METHODS[-1])
    return both.withColumn("eligible", able).drop("approved")


def decisions(evidence: DataFrame, most: int | None = None) -> DataFrame:
    """At each instant of a deployment: every method's newest evidence is carried on, and the strongest method that has any decides.

    One pair of target and canonical id resolves, several are ambiguous, and an instant without evidence that may link is
    unresolved. A resolved deployment's canonical id comes only from reviews, of the same target, that agree on one. The ids of
    the evidence that decided (and that gave the canonical id) are kept, and bound in the decision's own id. A deployment has a
    row an instant; with ``most``, deployments of more instants than that are shared by tasks.
    """
    pair = "struct<target:string,canonical:string>"
    item = F.struct("target", "canonical", (F.col("candidate_id") if "candidate_id" in evidence.columns else F.lit(None).cast("string")).alias("candidate_id"))
    none = F.array().cast("array<struct<target:string,canonical:string,candidate_id:string>>")
    usable = evidence.where("at is not null")
    timeline = usable.groupBy("deployment_key", "at").pivot("method", METHODS[:-1]).agg(F.array_sort(F.collect_set(F.when(F.col("eligible"), item))))
    timeline = temporal.last_known(timeline.withColumns({m: F.when(F.size(m) > 0, F.col(m)) for m in METHODS[:-1]}), "deployment_key", ["at"], METHODS[:-1], most)
    timeline = timeline.withColumn("_held", F.coalesce(*METHODS[:-1]))
    timeline = timeline.withColumn("_pairs", F.array_distinct(F.transform("_held", lambda x: F.struct(x["target"], x["canonical"]).cast(pair))))
    one = F.try_element_at("_pairs", F.lit(1))
    timeline = timeline.withColumn("_reviewed", F.filter(F.coalesce("curated", none), lambda x: x["canonical"].isNotNull() & x["target"].eqNullSafe(one["target"])))
    canonicals = F.array_distinct(F.transform("_reviewed", lambda x: x["canonical"]))
    state = F.when(F.col("_held").isNull(), "unresolved").when(F.size("_pairs") == 1, "resolved").otherwise("ambiguous")
    method = F.coalesce(*[F.when(F.col(m).isNotNull(), F.lit(m)) for m in METHODS[:-1]])
    resolved = F.size("_pairs") == 1
    assigned = F.when(resolved & (F.size(canonicals) == 1), "reviewed_reference").when(resolved & (F.size(canonicals) > 1), "ambiguous").otherwise("unassigned")
    chosen = F.concat(F.coalesce("_held", none), F.when(resolved, F.col("_reviewed")).otherwise(none))
    out = timeline.select(
        "deployment_key", F.col("at").alias("valid_from"), F.lead("at").over(Window.partitionBy("deployment_key").orderBy("at")).alias("valid_to"), method.alias("method"), state.alias("state"), F.when(resolved, one["target"]).alias("target"),
        F.when(resolved & (F.size(canonicals) == 1), F.element_at(canonicals, 1)).alias("canonical"), assigned.alias("canonical_status"), F.array_compact(F.array_sort(F.array_distinct(F.transform(F.coalesce("_held", none), lambda x: x["target"])))).alias("targets"),
        F.array_compact(F.array_sort(F.array_distinct(F.transform(chosen, lambda x: x["candidate_id"])))).alias("candidate_ids"),
    )
    bound = [F.col("deployment_key").cast("string"), F.date_format("valid_from", INSTANT), F.col("state"), F.col("target"), F.col("canonical"), F.to_json("candidate_ids")]
    return out.withColumn("decision_id", content_key(*bound))


def links(told: DataFrame) -> DataFrame:
    return told.where("state = 'resolved'")


def identity_at(probes: DataFrame, told: DataFrame, key: str, at: str, recorded_at: str, as_of: str | None = None) -> DataFrame:
    """What a replay, recorded at one instant, believed of each probe's key at its instant.

    ``unknown`` where no decision was in force; ``not_recorded`` everywhere if the replay is younger than ``as_of``. Decisions
    and probes are laid on one line by key and time, so that a key with many of either is no product of the two.
    """
    if as_of is not None and recorded_at > as_of:
        return probes.withColumns({"state": F.lit("not_recorded"), "target": F.lit(None).cast("string")})
    found = temporal.as_of(probes, told, key, at, ["state", "target"])
    return found.withColumn("state", F.coalesce("state", F.lit("unknown")))


def belief_events(told: DataFrame, key: str, at: str) -> DataFrame:
    """``linked`` at the first decision with a target, ``revised`` whenever the belief differs afterwards.

    A belief is its state, its target, and while it is ambiguous the targets it wavers between; ``told`` has ``state``, ``target``
    and ``targets``.
    """
    w = Window.partitionBy(key).orderBy(at)
    belief = F.struct("state", "target", F.when(F.col("state") == "ambiguous", F.col("targets")).otherwise(F.array().cast("array<string>")).alias("wavering"))
    rows = told.withColumn("_b", belief).withColumn("_linked", F.min(F.when(F.col("target").isNotNull(), F.col(at))).over(Window.partitionBy(key))).withColumn("_p", F.lag("_b").over(w))
    kind = F.when(F.col(at) == F.col("_linked"), "linked").when((F.col(at) > F.col("_linked")) & ~F.col("_b").eqNullSafe(F.col("_p")), "revised")
    return rows.withColumn("kind", kind).where("kind is not null").select(key, at, "kind", "state", "target", F.col("_b.wavering").alias("wavering"))


def evidence_violations(ledger: DataFrame, facts: DataFrame, recorded_at: Column) -> DataFrame:
    """(observation_id, rule) of reviews that may not be used: each rule a review breaks is a row."""
    rows = ledger.join(facts.select("observation_id", "deployment_key", "observed_at"), "observation_id", "left")
    there = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    broken = {
        "unknown_observation": F.col("deployment_key").isNull() & F.col("observed_at").isNull(),
        "method": ~F.coalesce(F.col("method").isin(METHODS[1:]), F.lit(False)),
        "unidentified_deployment": F.col("deployment_key").isNull(),
        "no_reference": ~there("evidence_reference"),
        "review_status": ~F.coalesce("review_status", F.lit("pending")).isin("pending", "approved", "rejected"),
        "approval_without_reviewer": (F.col("review_status") == "approved") & ~(there("reviewed_by") & there("review_reason")),
        "before_its_observation": F.col("available_at").isNotNull() & (F.col("observed_at").isNull() | (F.col("available_at") < F.col("observed_at"))),
        "from_the_future": F.col("available_at") > recorded_at,
        "canonical_without_review": F.col("canonical").isNotNull() & ~F.coalesce(F.col("method").isin("curated", "fuzzy"), F.lit(False)),
        "no_target": F.col("target").isNull() & F.col("canonical").isNull(),
    }
    each = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in broken.items()]))
    return rows.select("observation_id", F.explode(each).alias("rule"))
