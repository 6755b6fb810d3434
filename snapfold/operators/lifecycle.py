"""Outcomes of entities followed over days: eligibility before rate, absence is never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import medians


def iso_week(day: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def horizons(history: DataFrame, key: str, day: str, value: str, listed: str, days: list[int]) -> DataFrame:
    """A row for each entity and horizon N.

    An entity is eligible if it was followed for N + 1 days; then its milestone is the first row of day N or N + 1, it has
    entered if it was listed after its first day and no later than day N, and sustained that if on three days or more.
    None of these is filled in when it isn't eligible or has no row. ``history`` has the last day of all snapshots as ``_latest``.
    """
    w = Window.partitionBy(key)
    offset = F.date_diff(F.col(day), F.col("first_day"))
    rows = history.withColumn("first_day", F.min(day).over(w)).withColumn("_offset", offset)
    rows = rows.withColumn("horizon", F.explode(F.array(*[F.lit(n) for n in days])))
    h = F.col("horizon")
    at = (F.col("_offset") == h) | (F.col("_offset") == h + 1)
    inside = F.col(listed) & (F.col("_offset") > 0) & (F.col("_offset") <= h)
    out = rows.groupBy(key, "first_day", "horizon", "_latest").agg(
        F.min_by(F.when(at, F.col(value)), F.when(at, F.col("_offset"))).alias("_milestone"),
        F.count_distinct(F.when(inside, F.col("_offset"))).alias("_days"),
    )
    eligible = F.date_diff("_latest", "first_day") >= h + 1
    return out.select(
        key,
        "first_day",
        "horizon",
        eligible.alias("eligible"),
        F.when(eligible, F.col("_milestone")).alias("milestone"),
        F.when(eligible, F.col("_days") > 0).alias("entered"),
        F.when(eligible & (F.col("_days") > 0), F.col("_days") >= 3).alias("sustained"),
    )


def cohort_metrics(outcomes: DataFrame, exact: bool = False) -> DataFrame:
    """By week of first sight and horizon: sizes, counts, rates over the eligible, and the median milestone.

    ``exact`` finds medians by rank (``ranks.medians``), for groups with more distinct milestones than a task holds.
    """
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    keyed = outcomes.withColumn("week", iso_week(F.col("first_day")))
    sums = keyed.groupBy("week", "horizon").agg(
        F.count("*").alias("size"),
        count(F.col("eligible")).alias("n_eligible"),
        F.count("milestone").alias("n_observed"),
        count(F.col("entered")).alias("n_entered"),
        count(F.col("sustained")).alias("n_sustained"),
        *([] if exact else [F.median("milestone").alias("median_milestone")]),
    )
    if exact:
        sums = sums.join(medians(keyed, ["week", "horizon"], "milestone", "median_milestone"), ["week", "horizon"], "left")
    rate = lambda c: F.round(F.try_divide(F.col(c).cast("double"), F.col("n_eligible")), 6)
    return sums.withColumns({"median_milestone": F.round("median_milestone", 6), "entry_rate": rate("n_entered"), "sustained_rate": rate("n_sustained")})


def horizon_counts(outcomes: DataFrame, primary: Column, happened: DataFrame, kind: str) -> DataFrame:
    """(measure, label, n), as a build sums itself up: entities, primary ones, those of them eligible at each horizon, and events by kind."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    by = outcomes.groupBy("horizon").agg(F.count("*").alias("all"), n(primary).alias("primary"), n(primary & F.col("eligible")).alias("eligible"))
    eligible = by.select(F.lit("eligible_primary").alias("measure"), F.col("horizon").cast("string").alias("label"), F.col("eligible").alias("n"))
    # every entity has a row a horizon
    sizes = by.agg(F.max("all").alias("all"), F.max("primary").alias("primary")).unpivot([], ["all", "primary"], "label", "n").select(F.lit("entities").alias("measure"), "label", "n")
    events = happened.groupBy(F.lit("events").alias("measure"), F.col(kind).alias("label")).agg(F.count("*").alias("n"))
    return eligible.unionByName(sizes).unionByName(events)


def firsts(history: DataFrame, key: str, day: str, conditions: dict[str, Column]) -> DataFrame:
    """First day on which each condition held; null if it never did."""
    return history.groupBy(key).agg(F.min(day).alias("first_day"), *[F.min(F.when(c, F.col(day))).alias(n) for n, c in conditions.items()])


def as_events(wide: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    """Wide dates to (key, kind, day) rows; a date equal to the first day is left-censored, a null one no event."""
    long = wide.unpivot([key, "first_day"], kinds, "kind", "day").where("day is not null")
    return long.select(key, "kind", "day", (F.col("day") == F.col("first_day")).alias("left_censored"))


def entry_curve(entries: DataFrame, offset: str, last: int) -> DataFrame:
    """Share of one fixed cohort that has entered by each day 0 to ``last``; day 0 counts here."""
    spine = entries.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("day"))
    total = entries.agg(F.count("*").alias("cohort"))
    hist = entries.where(F.col(offset).between(0, last)).groupBy(F.col(offset).cast("int").alias("day")).count()
    running = F.sum(F.coalesce("count", F.lit(0))).over(Window.partitionBy(F.lit(0)).orderBy("day"))
    curve = spine.join(F.broadcast(hist), "day", "left").withColumn("n_entered", running)
    return curve.join(F.broadcast(total)).select("day", "n_entered", "cohort", F.round(F.try_divide(F.col("n_entered").cast("double"), F.col("cohort")), 6).alias("share"))


def mature_weeks(metrics: DataFrame, horizon: int) -> DataFrame:
    """Weekly entry rates of weeks that are eligible as a whole, and the pooled rate as week ``all``."""
    ripe = metrics.where((F.col("horizon") == horizon) & (F.col("n_eligible") == F.col("size")))
    rate = lambda: F.round(F.try_divide(F.sum("n_entered").cast("double"), F.sum("size")), 6)
    weekly = ripe.groupBy("week").agg(F.sum("size").alias("size"), F.sum("n_entered").alias("n_entered"), rate().alias("rate"))
    pooled = ripe.agg(F.lit("all").alias("week"), F.sum("size").alias("size"), F.sum("n_entered").alias("n_entered"), rate().alias("rate"))
    return weekly.unionByName(pooled)


def resolved_dates(references: DataFrame, targets: DataFrame, key: str, target: str, referred: str, seen: str) -> DataFrame:
    """The first day on which a reference of the entity and a thing that it refers to were both there."""
    first = references.groupBy(key).agg(F.min(referred).alias("_referred"))
    edges = references.select(key, target).distinct().join(first, key).join(targets, target)
    return edges.groupBy(key).agg(F.min(F.greatest("_referred", seen)).alias("resolved"))
