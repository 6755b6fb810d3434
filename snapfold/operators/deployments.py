"""Deployments out of provider facts: runs, roll-ups, batches that follow each other, and what changed between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import changed_keys
from ..session import spread


def source_runs(manifests: DataFrame, sources: list[str], snapshots: DataFrame) -> DataFrame:
    """One row a source and day with a manifest; a leg that the manifest lacks is ``not_applicable`` on a complete day, else ``pending``."""
    days = manifests.groupBy("day").agg(F.any_value("day_status").alias("run_status"))
    grid = days.withColumn("source", F.explode(F.array(*[F.lit(s) for s in sources])))
    legs = manifests.select("day", F.col("leg").alias("source"), F.col("status").alias("leg_status"))
    out = grid.join(legs, ["day", "source"], "left").join(snapshots.select("source", F.col("collection_day").alias("day"), "snapshot_id"), ["day", "source"], "left")
    return out.withColumn("leg_status", F.coalesce("leg_status", F.when(F.col("run_status") == "complete", "not_applicable").otherwise("pending")))


def roll_up(facts: DataFrame, runs: DataFrame, key: str, source: str, snapshot: str, day: str, at: str, target: str) -> DataFrame:
    """Bounds, counts and targets of each deployment, and whether the latest run of each of its sources still has it.

    A bound's instant is null if a fact of the bound's day has none. ``runs`` has source, day, leg_status and snapshot; a
    deployment is PRESENT if it stands in the latest applicable run of every source that ever had it, else UNKNOWN. Facts are dealt
    out by deployment once; the latest runs, a row a source, go to every task, as facts of a source would else meet in one.
    """
    span = [F.bool_or(F.col(at).isNull()).alias("_untimed"), F.min(at).alias("_least"), F.max(at).alias("_most")]
    base = spread(facts.where(F.col(key).isNotNull()), key).groupBy(key, source, snapshot, day).agg(F.count("*").alias("_n"), F.collect_set(F.nullif(target, F.lit(""))).alias("_targets"), *span)
    days = base.groupBy(key, day).agg(F.bool_or("_untimed").alias("_untimed"), F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    first, last = F.min_by(F.struct("_untimed", "_least"), day), F.max_by(F.struct("_untimed", "_most"), day)
    bounds = days.groupBy(key).agg(F.min(day).alias("first_day"), first.alias("_f"), F.max(day).alias("last_day"), last.alias("_l"))
    bounds = bounds.select(key, "first_day", F.when(~F.col("_f._untimed"), F.col("_f._least")).alias("first_at"), "last_day", F.when(~F.col("_l._untimed"), F.col("_l._most")).alias("last_at"))
    sums = base.groupBy(key).agg(F.sum("_n").alias("n_rows"), F.count_distinct(snapshot).alias("n_snapshots"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_targets")))).alias("targets"))
    latest = runs.where("leg_status <> 'not_applicable'").groupBy(F.col("source").alias("_s")).agg(F.max_by(F.struct("day", snapshot), "day").alias("run"))
    by_source = base.join(F.broadcast(latest), F.col(source) == F.col("_s"), "left").groupBy(key, source).agg(F.max(F.coalesce(F.col(snapshot) == F.col(f"run.{snapshot}"), F.lit(False))).alias("_there"), F.max("run.day").alias("_day"))
    state = by_source.groupBy(key).agg(F.when(F.bool_and("_there"), "PRESENT").otherwise("UNKNOWN").alias("state"), F.max("_day").alias("as_of_day"), F.count("*").alias("n_sources"))
    return bounds.join(sums, key).join(state, key)


def summary(facts: DataFrame, deployments: DataFrame, key: str, snapshot: str, at: str, groups: list[str]) -> DataFrame:
    """Counts of a layer as (measure, label, n): rows by each column of ``groups``, deployments by state, and what is unidentified, untimed or repeated."""
    by = [facts.groupBy(F.lit(f"rows_by_{g}").alias("measure"), F.col(g).cast("string").alias("label")).agg(F.count("*").alias("n")) for g in groups]
    by.append(deployments.groupBy(F.lit("deployments_by_state").alias("measure"), F.col("state").alias("label")).agg(F.count("*").alias("n")))
    all_of = facts.agg(F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("unidentified"), F.count_if(F.col(at).isNull()).alias("day_only"), F.count_distinct(snapshot).alias("snapshots"))
    by.append(all_of.unpivot([], ["rows", "unidentified", "day_only", "snapshots"], "label", "n").select(F.lit("totals").alias("measure"), "label", "n"))
    again = facts.where(F.col(key).isNotNull()).groupBy(key, snapshot).agg(F.count("*").alias("k")).agg(F.count_if(F.col("k") > 1).alias("n"))
    by.append(again.select(F.lit("totals").alias("measure"), F.lit("repeated_in_snapshot").alias("label"), "n"))
    out = by[0]
    for more in by[1:]:
        out = out.unionByName(more)
    return out


def _marks(value: str) -> dict[str, Column]:
    """Two fingerprints of a map's sorted entries; null for null."""
    entries = F.array_sort(F.map_entries(value))
    return {"_m1": F.when(entries.isNotNull(), F.xxhash64(entries)), "_m2": F.when(entries.isNotNull(), F.xxhash64(F.lit(2), entries))}


def _agree() -> Column:
    """Whether all maps of a group that aren't null are one; null if all are null."""
    return (F.min("_m1") == F.max("_m1")) & (F.min("_m2") == F.max("_m2"))


def batches(facts: DataFrame, series: list[str], snapshot: str, day: str, at: str, value: Column) -> DataFrame:
    """Facts of one series and snapshot as one batch: its instant, the latest of its rows, and its value.

    A batch with an untimed row has no instant; its day is a barrier: every batch of that day is cut off, and no later batch is
    compared with one before it. An untimed batch without a day takes its whole series out. The value is null, which cuts the
    chain too, where rows differ or say nothing (an empty map). Facts are dealt out by series once, for all that follows.
    """
    rows = spread(facts.withColumn("_v", value), *series).withColumns(_marks("_v"))
    out = rows.groupBy(*series, snapshot).agg(F.bool_or(F.col(at).isNull()).alias("untimed"), F.max(at).alias("_at"), F.max(day).alias("_day"), _agree().alias("_one"), F.any_value("_v", True).alias("_value"))
    w = Window.partitionBy(*series)
    out = out.withColumn("batch_day", F.when(F.col("untimed"), F.col("_day")).otherwise(F.to_date("_at"))).withColumn("_lost", F.bool_or(F.col("untimed") & F.col("_day").isNull()).over(w)).where("not _lost")
    barrier = F.bool_or("untimed").over(Window.partitionBy(*series, "batch_day"))
    return out.select(*series, snapshot, F.when(~F.col("untimed"), F.col("_at")).alias("batch_at"), "batch_day", barrier.alias("barrier"), F.when(~barrier & F.col("_one") & (F.size("_value") > 0), F.col("_value")).alias("value"))


def changes(told: DataFrame, series: list[str], same: list[str] | None = None) -> DataFrame:
    """Batches whose value differs, in a key that both have, from the batch right before them; ``same`` keys must agree (unit, currency).

    Several batches of one instant are one: they must agree, or the chain is cut.
    """
    marked = told.withColumns(_marks("value"))
    points = marked.groupBy(*series, "batch_day", F.col("batch_at").alias("at")).agg(_agree().alias("_one"), F.count_if(F.col("value").isNull()).alias("_cut"), F.any_value("value", True).alias("_v"))
    points = points.withColumn("value", F.when(F.col("_one") & (F.col("_cut") == 0), F.col("_v")))
    w = Window.partitionBy(*series).orderBy("batch_day", F.col("at").asc_nulls_first())
    rows = points.withColumn("previous", F.lag("value").over(w)).where("value is not null and previous is not null")
    fine = F.lit(True)
    for k in same or []:
        fine = fine & F.try_element_at("value", F.lit(k)).eqNullSafe(F.try_element_at("previous", F.lit(k)))
    rows = rows.where(fine).withColumn("changed", changed_keys(F.col("previous"), F.col("value")))
    return rows.where(F.size("changed") > 0).select(*series, "at", "batch_day", "previous", "value", "changed")


def first_listing(facts: DataFrame, key: str, day: str, at: str) -> DataFrame:
    """The first day of each deployment, and its first instant if every fact of that day has one; one with an undated fact has none."""
    w = Window.partitionBy(key)
    rows = facts.where(F.col(key).isNotNull()).withColumn("_first", F.min(day).over(w))
    on = F.col(day) == F.col("_first")
    out = rows.groupBy(key).agg(F.min(day).alias("first_day"), F.bool_or(F.col(day).isNull()).alias("_undated"), F.bool_or(on & F.col(at).isNull()).alias("_untimed"), F.min(F.when(on, F.col(at))).alias("_at"))
    return out.where("not _undated").select(key, "first_day", F.when(~F.col("_untimed"), F.col("_at")).alias("first_at"))
