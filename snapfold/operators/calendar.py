"""Days that should be there: spines, gaps, staleness and regressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import last_known


def spine(rows: DataFrame, day: str) -> DataFrame:
    """Every day from the first to the last."""
    ends = rows.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias(day))


def missing(rows: DataFrame, key: str, day: str) -> DataFrame:
    """(key, day) of the days between a key's first and last on which it has no row."""
    ends = rows.groupBy(key).agg(F.min(day).alias("a"), F.max(day).alias("b"))
    expected = ends.select(key, F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias(day))
    return expected.join(rows.select(key, day).distinct(), [key, day], "left_anti")


def findings_of_gaps(gaps: DataFrame, known: DataFrame, key: str, day: str) -> DataFrame:
    """Gaps as findings: a warning where acknowledged, else an error."""
    return gaps.join(known, day, "left").select(key, day, F.when(F.col("reason").isNotNull(), "WARN").otherwise("ERROR").alias("level"), F.coalesce("reason", F.lit("no snapshot")).alias("message"))


def completed_range(start: str, end: str, today: str) -> tuple[str, str]:
    """The range, if it is of completed days in order; ``today`` is given, never read from a clock."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first > last or last >= date.fromisoformat(today):
        raise ValueError("a range must be of completed days in increasing order")
    return start, end


def report_window(days: int, today: str, end: str | None = None) -> tuple[str, str]:
    """First and last of the 1 to 30 completed days that end with ``end``, or with the day before ``today``."""
    if not 1 <= days <= 30:
        raise ValueError("a window has 1 to 30 days")
    last = date.fromisoformat(end) if end else date.fromisoformat(today) - timedelta(days=1)
    return completed_range((last - timedelta(days=days - 1)).isoformat(), last.isoformat(), today)


def expected(keys: DataFrame, metrics: list[str], start: str, end: str, day: str) -> DataFrame:
    """Every key, day from ``start`` to ``end``, and metric."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day")))
    return keys.distinct().withColumn(day, days).withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))


def missing_metrics(keys: DataFrame, observed: DataFrame, metrics: list[str], start: str, end: str, day: str) -> DataFrame:
    """Expected (key, day, metric) that weren't observed."""
    grid = expected(keys, metrics, start, end, day)
    return grid.join(observed.select(*grid.columns).distinct(), grid.columns, "left_anti")


def coverage(rows: DataFrame, source: str, day: str, ok: Column) -> DataFrame:
    """Every source and day of the calendar: ``ok``, ``partial``, ``missing``, or ``not_started`` before the source's first day."""
    state = rows.groupBy(source, day).agg(F.bool_and(ok).alias("_ok"), F.count("*").alias("n_rows"))
    starts = state.groupBy(source).agg(F.min(day).alias("_start"), F.max(day).alias("_end"))
    all_sources = Window.partitionBy(F.lit(0))  # one row a source
    starts = starts.withColumns({"_first": F.min("_start").over(all_sources), "_last": F.max("_end").over(all_sources)})
    calendar = starts.select(source, "_start", F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(day))
    out = calendar.join(state, [source, day], "left")
    label = F.when(F.col(day) < F.col("_start"), "not_started").when(F.col("_ok").isNull(), "missing").when(F.col("_ok"), "ok").otherwise("partial")
    return out.select(source, day, label.alias("status"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def carried(rows: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Each row with the last known value up to it."""
    return last_known(rows.withColumn(f"carried_{value}", F.col(value)), key, [day], [f"carried_{value}"])


def regressions(counts: DataFrame, key: str, day: str, n: str, valid: Column, warn: float, error: float) -> DataFrame:
    """Drops of a count against the previous valid day, by their size."""
    w = Window.partitionBy(key).orderBy(day)
    rows = counts.where(valid).withColumn("previous", F.lag(n).over(w))
    drop = 1 - F.try_divide(F.col(n).cast("double"), F.col("previous"))
    out = rows.withColumn("drop", F.round(drop, 6)).where(F.col("drop") >= warn)
    return out.select(key, day, "previous", n, "drop", F.when(F.col("drop") >= error, "ERROR").otherwise("WARN").alias("level"))


def coverage_regressions(rows: DataFrame, key: str, day: str, requested: str, stored: str, warn: float = 0.05, error: float = 0.2) -> DataFrame:
    """Drops of the ratio of stored to requested against the previous valid day, and requests that shrank; as findings.

    A day is valid if something was requested and it is known how much was stored.
    """
    valid = rows.where((F.col(requested) > 0) & F.col(stored).isNotNull()).withColumn("ratio", F.col(stored) / F.col(requested))
    w = Window.partitionBy(key).orderBy(day)
    told = valid.withColumns({"_ratio": F.lag("ratio").over(w), "_requested": F.lag(requested).over(w)}).withColumn("drop", F.round(F.col("_ratio") - F.col("ratio"), 9))
    thin = F.when(F.col("drop") >= error, "ERROR").when(F.col("drop") >= warn, "WARN")
    shrunk = F.when(F.col(requested) < F.col("_requested") * (1 - error), "WARN")
    found = F.array_compact(F.array(F.when(thin.isNotNull(), F.struct(F.lit("coverage").alias("check"), thin.alias("level"))), F.when(shrunk.isNotNull(), F.struct(F.lit("catalogue").alias("check"), shrunk.alias("level")))))
    return told.withColumn("_f", F.explode(found)).select(key, day, "_f.check", "_f.level", requested, stored, F.round("drop", 6).alias("drop"))


def stale(rows: DataFrame, source: str, day: str, today: str, most: int) -> DataFrame:
    """Sources whose last day is more than ``most`` days before ``today``, which is given, never read from a clock."""
    last = rows.groupBy(source).agg(F.max(day).alias("last_day")).withColumn("lag_days", F.date_diff(F.lit(today).cast("date"), F.col("last_day")))
    return last.where(F.col("lag_days") > most)


def completeness(rows: DataFrame, day: str, leg: str, legs: list[str]) -> DataFrame:
    """Days with the legs that are unfinished; a day is complete if none is."""
    seen = rows.groupBy(day).agg(F.collect_set(leg).alias("_seen"))
    wanted = F.array_sort(F.array(*[F.lit(x) for x in legs]))
    return seen.select(day, F.array_join(F.array_except(wanted, "_seen"), ",").alias("unfinished"), (F.size(F.array_except(wanted, "_seen")) == 0).alias("complete"))
