"""Rules that data must keep, each giving the rows that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import strict_instant, valid_repo
from .quality import bag_difference


def repeated(rows: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """(subject, rule) of keys that more than one row has."""
    many = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return many.select(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]).alias("subject"), F.lit(rule).alias("rule"))


def unique_and_past(rows: DataFrame, key: str, at: str, recorded_at: Column, name: str) -> DataFrame:
    """Ids that are there twice, and rows from after the instant at which they were recorded."""
    late = rows.where(F.col(at) > recorded_at).select(F.col(key).cast("string").alias("subject"), F.lit(f"{name}_from_the_future").alias("rule"))
    return repeated(rows, [key], f"{name}_not_unique").unionByName(late)


def lifecycle_rules(lifecycle: DataFrame, events: DataFrame, routes: DataFrame, key: str, horizons: list[int]) -> DataFrame:
    """(subject, rule): unique ids, one event of a kind, no negative lags, consistent eligibility, no milestone before its time, route counts that are those of the routes.

    ``lifecycle`` has key, age_days, followup_days, route_count, any lag columns ``days_to_*``, and for each horizon N ``eligible_N`` and ``milestone_N``.
    """
    lags = [c for c in lifecycle.columns if c.startswith("days_to_")]
    counted = routes.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_routes"))
    rows = lifecycle.join(counted, F.col(key) == F.col("_key"), "left")
    broken = {"created_after_first_seen": F.col("age_days") < 0, "route_count": ~F.col("route_count").eqNullSafe(F.coalesce("_routes", F.lit(0)))}
    broken |= {f"negative_{c}": F.col(c) < 0 for c in lags}
    for n in horizons:
        broken[f"eligibility_{n}"] = ~F.col(f"eligible_{n}").eqNullSafe(F.col("followup_days") >= n + 1)
        broken[f"immature_milestone_{n}"] = ~F.col(f"eligible_{n}") & F.col(f"milestone_{n}").isNotNull()
    each = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in broken.items()]))
    own = rows.select(F.col(key).cast("string").alias("subject"), F.explode(each).alias("rule"))
    return own.unionByName(repeated(lifecycle, [key], "id_not_unique")).unionByName(repeated(events, [key, "kind"], "event_kind_not_unique"))


def usage_rules(rows: DataFrame, batch: list[str], key: str, value: str, other: str, percent: Column, slack: float = 0.05) -> DataFrame:
    """(batch columns, rule, detail): keys that are there twice, values that are none, shares that don't sum to 100, and batches without a remainder."""
    twice = rows.groupBy(*batch, key).agg(F.count("*").alias("_n")).where("_n > 1").select(*batch, F.lit("duplicate_key").alias("rule"), F.col(key).cast("string").alias("detail"))
    above = percent & (F.col(value) > 100)
    bad = rows.where(F.coalesce(F.isnan(value) | (F.col(value) < 0) | above, F.lit(True))).select(*batch, F.lit("invalid_value").alias("rule"), F.col(key).cast("string").alias("detail"))
    sums = rows.groupBy(*batch).agg(F.sum(value).alias("_sum"), F.bool_or(percent).alias("_percent"), F.bool_or(other).alias("_other"))
    off = sums.where(F.col("_percent") & (F.abs(F.col("_sum") - 100) > slack)).select(*batch, F.lit("sum_not_100").alias("rule"), F.round("_sum", 4).cast("string").alias("detail"))
    none = sums.where(~F.coalesce("_other", F.lit(False))).select(*batch, F.lit("no_remainder").alias("rule"), F.lit("").alias("detail"))
    return twice.unionByName(bad).unionByName(off).unionByName(none)


def series_rules(rows: DataFrame, series: str, name: str, position: str, day: str, share: str, start: str, end: str, slack: float = 0.001) -> DataFrame:
    """(series, rule, detail) of share series: days that are there twice, names of unequal length, shares that are none, days whose shares don't sum to 100, requested days that lack.

    Days outside of ``start`` to ``end`` are a boundary bucket: they may be there, and only their uniqueness is looked at.
    """
    days = rows.groupBy(series, position).agg(F.min(day).alias(day))
    twice = days.groupBy(series, day).agg(F.count("*").alias("_n")).where("_n > 1").select(series, F.lit("duplicate_day").alias("rule"), F.col(day).cast("string").alias("detail"))
    sizes = rows.groupBy(series, name).agg(F.count("*").alias("_n")).join(days.groupBy(series).agg(F.count("*").alias("_all")), series)
    short = sizes.where("_n <> _all").select(series, F.lit("unequal_length").alias("rule"), F.col(name).cast("string").alias("detail"))
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = rows.where(F.col(day).between(first, last))
    bad = inside.where(F.coalesce(F.isnan(share) | (F.col(share) < 0) | (F.col(share) == float("inf")), F.lit(True))).select(series, F.lit("invalid_share").alias("rule"), F.concat_ws("|", F.col(name).cast("string"), F.col(day).cast("string")).alias("detail"))
    sums = inside.groupBy(series, day).agg(F.sum(share).alias("_sum")).where(F.abs(F.col("_sum") - 100) > slack)
    off = sums.select(series, F.lit("sum_not_100").alias("rule"), F.col(day).cast("string").alias("detail"))
    expected = rows.select(series).distinct().withColumn(day, F.explode(F.sequence(first, last, F.expr("interval 1 day"))))
    lack = expected.join(inside.select(series, day).distinct(), [series, day], "left_anti").select(series, F.lit("missing_day").alias("rule"), F.col(day).cast("string").alias("detail"))
    return twice.unionByName(short).unionByName(bad).unionByName(off).unionByName(lack)


def series_quality(rows: DataFrame, series: str, name: str, position: str, day: str, start: str, end: str) -> DataFrame:
    """Days, rows and names of each series within the requested days, and how many boundary buckets were left out."""
    marked = rows.withColumn("_in", F.coalesce(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False)))
    inside = lambda c: F.when(F.col("_in"), F.col(c))
    return marked.groupBy(series).agg(F.count_distinct(inside(day)).alias("n_days"), F.count_if("_in").alias("n_rows"), F.count_distinct(inside(name)).alias("n_names"), F.count_distinct(F.when(~F.col("_in"), F.col(position))).alias("n_excluded"))


def registry_rules(members: DataFrame, cohort: str = "cohort_id", key: str = "hf_repo_id") -> DataFrame:
    """(cohort, subject, rule) of a registry: member ids that are none or there twice, instants without an offset, cohort ids that are none."""
    broken = {
        "cohort_id": ~F.coalesce(F.col(cohort).rlike("^[A-Za-z0-9_-]{1,128}$"), F.lit(False)),
        "member_id": ~valid_repo(F.col(key)),
        "active": F.col("active").isNull(),
        "selected_at": strict_instant(F.col("selected_at")).isNull(),
        "enrolled_at": strict_instant(F.col("enrolled_at")).isNull(),
    }
    each = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()]))
    own = members.select(cohort, F.coalesce(key, F.lit("")).alias("subject"), F.explode(each).alias("rule"))
    twice = members.groupBy(cohort, key).agg(F.count("*").alias("_n")).where("_n > 1").select(cohort, F.coalesce(key, F.lit("")).alias("subject"), F.lit("duplicate_member").alias("rule"))
    return own.unionByName(twice)


def frozen(told: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, field) of what a sample's inputs were said to be and no longer are: digests, cutoffs, sizes; a key that only one side has counts too."""
    fields = [c for c in told.columns if c != key]
    a, b = told.alias("a"), found.alias("b")
    both = a.join(b, F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full_outer")
    each = F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in fields]))
    return both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.explode(each).alias("field"))


def stale_index(told: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of a stored index that a fresh one lacks, and the other way round; none if it may be used."""
    columns = told.columns
    return bag_difference(told, fresh.select(*columns))


def reconciled(source: DataFrame, result: DataFrame, keys: list[str], values: list[str], slack: float = 1e-9) -> DataFrame:
    """(keys, problem) between a source recomputed and a stored result: rows that only one has, and values that differ by more than ``slack``."""
    a, b = source.withColumn("_a", F.lit(True)).alias("a"), result.withColumn("_b", F.lit(True)).alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = a.join(b, on, "full_outer")
    differs = lambda c: ~F.coalesce(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= slack, F.col(f"a.{c}").isNull() & F.col(f"b.{c}").isNull())
    each = F.when(F.col("_b").isNull(), F.array(F.lit("missing_in_result"))).when(F.col("_a").isNull(), F.array(F.lit("only_in_result"))).otherwise(F.array_compact(F.array(*[F.when(differs(c), F.lit(f"differs_{c}")) for c in values])))
    return both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], F.explode(each).alias("problem"))
