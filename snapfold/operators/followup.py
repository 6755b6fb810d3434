"""Following a fixed cohort: who was seen already, who is still to be asked, and what became of the asking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import response_reason
from .dedup import precedence


def enrolled(members: DataFrame, day: Column) -> DataFrame:
    """Active members that were enrolled, in a cohort that was selected, on the day or before; one row each."""
    begun = (F.to_date("enrolled_at") <= day) & (F.to_date("selected_at") <= day)
    return members.where(F.coalesce("active", F.lit(True)) & begun).select("hf_repo_id").distinct()


def observed(members: DataFrame, found: DataFrame, order: list[str]) -> DataFrame:
    """Members that other sources saw on the day: the row of the strongest source, and all sources that saw them.

    ``found`` has hf_repo_id, id, model_id, downloads, likes, http_status, source_leg and further columns; answers under another id,
    without counts, or with another status than 200 are no observations.
    """
    fine = found.where((F.col("http_status") == 200) & response_reason(F.col("hf_repo_id"), F.col("id"), F.col("model_id"), F.col("downloads"), F.col("likes")).isNull())
    rank = precedence("source_leg", order)
    mine = fine.join(members.select("hf_repo_id"), "hf_repo_id", "left_semi")
    first = F.min_by(F.struct(*[c for c in found.columns if c != "hf_repo_id"]), F.struct(rank, F.to_json(F.struct(*found.columns))))
    legs = F.transform(F.array_sort(F.collect_set(F.struct(rank.alias("r"), F.col("source_leg").alias("s")))), lambda x: x["s"])
    return mine.groupBy("hf_repo_id").agg(first.alias("f"), legs.alias("discovery_sources")).select("hf_repo_id", "f.*", "discovery_sources")


def to_poll(members: DataFrame, seen: DataFrame, settled: DataFrame) -> DataFrame:
    """Members without an observation and without a failure that settles the day."""
    done = seen.select("hf_repo_id").unionByName(settled.select("hf_repo_id"))
    return members.select("hf_repo_id").join(done, "hf_repo_id", "left_anti")


def poll_coverage(members: DataFrame, stored: DataFrame, failures: DataFrame, deferred: DataFrame, discovery: list[str]) -> DataFrame:
    """One row: members, attempted, successful, reused from other sources, coverage, and failures and deferrals by reason.

    ``stored``, ``failures`` and ``deferred`` have hf_repo_id; the first source_leg, the others reason.
    """
    marks = lambda df, kind, label: df.join(members.select("hf_repo_id"), "hf_repo_id", "left_semi").select(F.lit(kind).alias("kind"), label.alias("label"))
    all_of = members.select(F.lit("member").alias("kind"), F.lit("").alias("label"))
    all_of = all_of.unionByName(marks(stored, "stored", F.col("source_leg"))).unionByName(marks(failures, "failed", F.col("reason"))).unionByName(marks(deferred, "deferred", F.col("reason")))
    by = all_of.groupBy("kind", "label").agg(F.count("*").alias("n"))
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    kind = F.col("kind")
    reasons = lambda k: F.array_join(F.array_sort(F.collect_list(F.when(kind == k, F.concat(F.coalesce("label", F.lit("unknown")), F.lit("="), F.col("n"))))), ",")
    sums = by.agg(
        n(kind == "member").alias("n_members"), (n(kind == "stored") + n(kind == "failed")).alias("attempted"), n(kind == "stored").alias("successful"), n((kind == "stored") & F.col("label").isin(discovery)).alias("reused"),
        n(kind == "deferred").alias("n_deferred"), reasons("failed").alias("failed_by_reason"), reasons("deferred").alias("deferred_by_reason"),
    )
    return sums.withColumn("coverage", F.round(F.try_divide(F.col("successful").cast("double"), F.col("n_members")), 6))


def identity_reviews(failures: DataFrame, members: DataFrame) -> DataFrame:
    """Failures of members that answered under another id: rows of a review queue, all pending; none is ever taken as a rename."""
    mine = failures.where("reason = 'identity_mismatch'").join(members.select("hf_repo_id", "selection_group"), "hf_repo_id")
    return mine.select("day", "selection_group", F.col("hf_repo_id").alias("requested_id"), "response_id", "http_status", F.lit("pending_review").alias("decision"))


def wanted_ids(routes: DataFrame, column: str = "hugging_face_id") -> DataFrame:
    """Distinct ids that routes declare, empty ones left out."""
    return routes.where(F.coalesce(F.col(column) != "", F.lit(False))).select(column).distinct()
