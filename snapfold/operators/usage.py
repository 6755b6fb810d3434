"""Usage shares with published denominators, and their attribution to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import as_of, open_sets


def shares(rows: DataFrame, keys: list[str], name: str, value: str) -> DataFrame:
    """Each name's share of its key's total, in percent, with the total it is a share of."""
    sums = rows.groupBy(*keys, name).agg(F.sum(value).alias("amount"))
    total = F.sum("amount").over(Window.partitionBy(*keys))
    return sums.withColumn("total", total).withColumn("share_percent", 100 * F.try_divide("amount", "total"))


def denominators(rows: DataFrame, keys: list[str], share: str, slack: float = 0.05) -> DataFrame:
    """Keys whose shares don't sum to 100, or hold a share below 0 or above 100."""
    sums = rows.groupBy(*keys).agg(F.sum(share).alias("sum_percent"), F.count_if((F.col(share) < 0) | (F.col(share) > 100)).alias("n_outside"))
    return sums.where((F.abs(F.col("sum_percent") - 100) > slack) | (F.col("n_outside") > 0))


def coverage(rows: DataFrame, keys: list[str], value: str, attributed: Column, other: Column) -> DataFrame:
    """Total, attributed and other amounts of each key, and the shares that they are."""
    part = lambda c: F.sum(F.when(c, F.col(value)).otherwise(0.0))
    sums = rows.groupBy(*keys).agg(F.sum(value).alias("total"), part(attributed).alias("attributed"), part(other).alias("other"), F.count_if(attributed).alias("n_attributed"), F.count("*").alias("n_rows"))
    return sums.withColumn("attributed_share", F.try_divide("attributed", "total")).withColumn("other_share", F.try_divide("other", "total"))


def window(rows: DataFrame, keys: list[str], day: str, start: str, end: str, value: str, unit: str) -> DataFrame:
    """Amounts within the window: plain sums, but daily means over the observed days where the unit is percent."""
    inside = rows.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    sums = inside.groupBy(*keys, unit).agg(F.sum(value).alias("_sum"), F.count_distinct(day).alias("n_days"), F.count("*").alias("n_rows"))
    return sums.withColumn("amount", F.when(F.col(unit) == "percent", F.try_divide("_sum", "n_days")).otherwise(F.col("_sum"))).drop("_sum")


def in_force(facts: DataFrame, ledger: DataFrame, key: str, day: str) -> DataFrame:
    """Facts with the reviewed targets whose validity holds their day, and what these make of the identity; equal facts stay apart.

    The reviews' validity is cut into segments with one set of targets each, which the facts look up as of their day: a key with
    many facts and many reviews costs their sum.
    """
    usable = ledger.where(F.col("reviewer").isNotNull() & F.col("evidence").isNotNull())
    found = as_of(facts, open_sets(usable, key, "target", "valid_from", "valid_until"), key, day, ["targets"])
    found = found.withColumn("targets", F.coalesce("targets", F.array().cast("array<string>")))
    state = F.when(F.size("targets") == 0, "unresolved").when(F.size("targets") == 1, "curated").otherwise("ambiguous")
    return found.withColumn("state", state)


def claims(rows: DataFrame, keys: list[str], target: str) -> DataFrame:
    """Distinct declared targets of each key; an empty declaration is a value of its own."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(F.coalesce(target, F.lit("")))).alias("claimed"))


def claim_state(claimed: str, target: str = "target") -> list[Column]:
    """One valid target resolves; one beside others, or beside an empty one, is ambiguous; none is unresolved."""
    c = F.col(claimed)
    valid = F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x != "")
    state = F.when(F.size(valid) == 0, "unresolved").when((F.size(valid) == 1) & (F.size(c) == 1), "source_explicit").otherwise("ambiguous")
    return [state.alias("state"), F.when((F.size(valid) == 1) & (F.size(c) == 1), F.element_at(valid, 1)).alias(target)]


def queue(rows: DataFrame, keys: list[str], value: str, linked: Column, evidence: str) -> DataFrame:
    """Unlinked names by falling amount, each with its sorted evidence."""
    out = rows.where(~linked).groupBy(*keys).agg(F.sum(value).alias("priority"), F.count("*").alias("n_rows"), F.array_join(F.array_sort(F.collect_set(evidence)), ",").alias("evidence"))
    return out.orderBy(F.desc("priority"), *keys)


def funnel(rows: DataFrame, keys: list[str], value: str, steps: dict[str, Column]) -> DataFrame:
    """How much of each key's total passes each step."""
    return rows.groupBy(*keys).agg(F.sum(value).alias("total"), *[F.sum(F.when(c, F.col(value)).otherwise(0.0)).alias(n) for n, c in steps.items()])
