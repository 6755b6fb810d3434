"""Marts on top of the canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hosting(rows: DataFrame, entity: str, day: str, provider: str, status: str, locator: list[str], live: str = "live") -> DataFrame:
    """Declared and live providers of each entity and day, a count for each status, and where the rows stand.

    A row without a provider is an empty mapping: an entity with none but these is ``unknown``, others are ``declared``. A
    mapping without a status counts as ``unknown``.
    """
    there = F.col(provider).isNotNull()
    each = rows.groupBy(entity, day, provider, F.when(there, F.coalesce(status, F.lit("unknown"))).alias("_status")).agg(F.count("*").alias("_n"), F.collect_set(F.array(*locator)).alias("_at"))
    told = each.groupBy(entity, day).agg(F.collect_list(F.struct(F.col(provider).alias("p"), F.col("_status").alias("s"), F.col("_n").alias("n"))).alias("_told"), F.flatten(F.collect_list("_at")).alias("_at"))
    named = F.filter("_told", lambda x: x["p"].isNotNull())
    of = lambda s: F.aggregate(F.filter("_told", lambda x: x["s"] == s), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    statuses = F.array_distinct(F.transform(named, lambda x: x["s"]))
    sums = told.select(
        entity,
        day,
        F.array_distinct(F.transform(named, lambda x: x["p"])).alias("_declared"),
        F.array_sort(F.transform(F.filter(named, lambda x: x["s"] == live), lambda x: x["p"])).alias("_live"),
        F.array_sort(F.transform(statuses, lambda s: F.concat(s, F.lit("="), of(s)))).alias("_statuses"),
        F.array_sort(F.array_distinct("_at")).alias("_rows"),
    )
    return sums.select(
        entity, day, F.size("_declared").alias("n_declared"), F.size("_live").alias("n_live"), F.array_join("_live", ",").alias("live_providers"), F.array_join("_statuses", ",").alias("statuses"),
        F.when(F.size("_declared") > 0, "declared").otherwise("unknown").alias("state"), F.to_json("_rows").alias("row_locators"),
    )


def cards(entities: DataFrame, rows: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """Entities with their rows nested in order; an entity without rows has an empty list."""
    held = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias("items"), F.count("*").alias("n_items"))
    empty = F.array().cast(held.schema["items"].dataType)
    return entities.join(held, key, "left").withColumns({"items": F.coalesce("items", empty), "n_items": F.coalesce("n_items", F.lit(0))})


def outcomes(members: DataFrame, days: Column, seen: DataFrame, failed: DataFrame, key: str, day: str) -> DataFrame:
    """What became of each member on each of ``days``, an array: observed, the reason of its failure, or unobserved."""
    grid = members.select(key, F.explode(days).alias(day))
    out = grid.join(seen.select(key, day).distinct().withColumn("_seen", F.lit(True)), [key, day], "left").join(failed, [key, day], "left")
    return out.select(key, day, F.when(F.col("_seen"), "observed").otherwise(F.coalesce("reason", F.lit("unobserved"))).alias("outcome"))


def outcome_coverage(told: DataFrame, day: str) -> DataFrame:
    """Coverage of each day, and the reasons of what is missing as sorted text."""
    by = told.groupBy(day, "outcome").agg(F.count("*").alias("n"))
    reason = F.when(F.col("outcome") != "observed", F.concat_ws("=", "outcome", "n"))
    out = by.groupBy(day).agg(F.sum("n").alias("n_members"), F.sum(F.when(F.col("outcome") == "observed", F.col("n")).otherwise(0)).alias("n_observed"), F.array_join(F.array_sort(F.collect_list(reason)), ",").alias("reasons"))
    return out.withColumn("coverage", F.round(F.col("n_observed") / F.col("n_members"), 6))


def changes(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Keys in both snapshots, with the change of their value."""
    return before.withColumnRenamed(value, "before").join(after.withColumnRenamed(value, "after"), key).withColumn("change", F.col("after") - F.col("before"))


def sample_profile(rows: DataFrame, group: str, value: str, field: Column) -> DataFrame:
    return rows.groupBy(group).agg(F.count("*").alias("n_rows"), F.round(F.min(value), 6).alias("least"), F.round(F.median(value), 6).alias("median"), F.round(F.max(value), 6).alias("most"), F.count_if(F.coalesce(field, F.lit(False))).alias("n_populated"))
