"""Trajectories of irregularly observed metrics; a missing value is never bridged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_changes(rows: DataFrame, key: str, day: str, value: str, at: str | None = None) -> DataFrame:
    """Adjacent observations: time between them, the change, the change a day and relative to the first; null if either value is.

    The time is that between their instants where both have one, else between their days; ``basis`` tells which.
    """
    w = Window.partitionBy(key).orderBy(day)
    instant = F.lit(None).cast("timestamp") if at is None else F.col(at)
    out = rows.withColumn("_at", instant).withColumns({"previous_day": F.lag(day).over(w), "_p": F.lag(value).over(w), "_before": F.lag("_at").over(w)}).where("previous_day is not null")
    timed = F.col("_at").isNotNull() & F.col("_before").isNotNull()
    seconds = F.unix_micros(F.col("_at").cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp"))
    gap = F.when(timed, seconds / 86400e6).otherwise(F.date_diff(day, "previous_day").cast("double"))
    change = F.col(value) - F.col("_p")
    return out.select(
        key, "previous_day", day, gap.alias("elapsed_days"), change.alias("change"), F.try_divide(change.cast("double"), gap).alias("change_per_day"), relative(F.col("_p"), F.col(value)).alias("relative_change"), F.when(timed, "fetched_at").otherwise("date").alias("basis"),
    )


def relative(first: Column, last: Column) -> Column:
    return F.when(first > 0, (last - first) / first)


def features(rows: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Span, coverage, widest gap, and the first and last known value of each trajectory."""
    w = Window.partitionBy(key).orderBy(day)
    there = F.col(value).isNotNull()
    g = rows.withColumn("_gap", F.date_diff(day, F.lag(day).over(w)))
    out = g.groupBy(key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_days"), F.coalesce(F.max("_gap"), F.lit(0)).alias("max_gap"), F.count(value).alias("n_values"),
        F.min_by(value, F.when(there, F.col(day))).alias("first_value"), F.max_by(value, F.when(there, F.col(day))).alias("last_value"),
    )
    span = F.date_diff("last_day", "first_day")
    return out.withColumn("span_days", span).withColumn("coverage", F.col("n_days") / (span + 1)).withColumn("relative_change", relative(F.col("first_value"), F.col("last_value")))


def shapes(rows: DataFrame, key: str, day: str, value: str, least: int = 4) -> DataFrame:
    """Peak with its rise and fall, reversals, total variation, volatility, and the shares of weekly block medians that rise and fall.

    A change counts between adjacent observations that both have a value. Blocks are seven days from the first observation, with a
    value or not; those with fewer than ``least`` values vanish, and their changes are taken between those left.
    """
    k = Window.partitionBy(key)
    w = k.orderBy(day)
    steps = rows.withColumns({"_first": F.min(day).over(k), "_d": F.col(value) - F.lag(value).over(w)})
    moves = steps.where("_d <> 0").withColumn("_turn", F.signum("_d") * F.signum(F.lag("_d").over(w)) < 0)
    turns = moves.groupBy(key).agg(F.count_if(F.coalesce("_turn", F.lit(False))).alias("reversals"))
    there = F.col(value).isNotNull()
    base = steps.groupBy(key).agg(
        F.max(value).alias("peak"), F.min_by(day, F.when(there, F.struct(-F.col(value), F.col(day)))).alias("peak_day"), F.coalesce(F.sum(F.abs("_d")), F.lit(0.0)).alias("total_variation"),
        (F.stddev_pop("_d") / F.greatest(F.avg(value), F.lit(1.0))).alias("volatility"), F.min_by(value, F.when(there, F.col(day))).alias("_from"), F.max_by(value, F.when(there, F.col(day))).alias("_to"),
        F.min(F.when(there, F.col(day))).alias("_start"), F.max(F.when(there, F.col(day))).alias("_end"),
    )
    blocks = steps.where(there).groupBy(key, F.floor(F.date_diff(day, "_first") / 7).alias("block")).agg(F.count("*").alias("n"), F.median(value).alias("m")).where(F.col("n") >= least)
    share = lambda c: F.coalesce(F.try_divide(F.count_if(c).cast("double"), F.count("_c")), F.lit(0.0))
    delta = blocks.withColumn("_c", F.col("m") - F.lag("m").over(k.orderBy("block"))).groupBy(key).agg(F.count("*").alias("n_blocks"), share(F.col("_c") > 0).alias("up_share"), share(F.col("_c") < 0).alias("down_share"))
    out = base.join(turns, key, "left").join(delta, key, "left")
    zero = lambda c, of: F.coalesce(c, F.lit(of))
    inside = F.coalesce((F.col("_start") < F.col("peak_day")) & (F.col("peak_day") < F.col("_end")), F.lit(False))
    return out.withColumns({
        "reversals": zero("reversals", 0), "n_blocks": zero("n_blocks", 0), "up_share": zero("up_share", 0.0), "down_share": zero("down_share", 0.0),
        "peak_rise": zero(F.col("peak") - F.col("_from"), 0.0), "peak_fall": zero(F.col("peak") - F.col("_to"), 0.0), "interior_peak": inside,
    }).drop("_from", "_to", "_start", "_end")


def research_summary(rows: DataFrame, key: str, day: str, source: str, values: list[str], cutoff: str) -> DataFrame:
    """(measure, label, n): observations a trajectory, rows by source, missing values, gaps between observations, rows up to and after a cutoff."""
    named = lambda df, measure, label: df.groupBy(F.lit(measure).alias("measure"), label.cast("string").alias("label")).agg(F.count("*").alias("n"))
    per = rows.groupBy(key).agg(F.count("*").alias("_n"))
    gaps = rows.withColumn("_gap", F.date_diff(day, F.lag(day).over(Window.partitionBy(key).orderBy(day)))).where("_gap is not null")
    side = F.when(F.col(day) <= F.lit(cutoff).cast("date"), "overlap").otherwise("extension")
    out = named(per, "observations", F.col("_n")).unionByName(named(rows, "source", F.col(source))).unionByName(named(gaps, "gap_days", F.col("_gap"))).unionByName(named(rows, "cutoff", side))
    missing = rows.agg(*[F.count_if(F.col(v).isNull()).alias(v) for v in values]).unpivot([], values, "label", "n").select(F.lit("missing").alias("measure"), "label", "n")
    return out.unionByName(missing)


def screens(rows: DataFrame, thresholds: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many trajectories pass each screen under each named set of thresholds."""
    return rows.crossJoin(F.broadcast(thresholds)).groupBy("name").agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])


def pick(rows: DataFrame, key: str, reasons: dict[str, tuple[Column, str]]) -> DataFrame:
    """For each reason in turn, the best entity that passes it and wasn't picked yet; ties by key."""
    each = F.array_compact(F.array(*[F.when(F.coalesce(passes, F.lit(False)), F.struct(F.lit(i).alias("i"), F.lit(n).alias("reason"), F.col(score).cast("double").alias("score"))) for i, (n, (passes, score)) in enumerate(reasons.items())]))
    told = rows.select(key, F.explode(each).alias("e")).select("e.i", "e.reason", "e.score", key)
    w = Window.partitionBy("i").orderBy(F.desc("score"), key)
    best = told.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= len(reasons))
    # as many rows as reasons times reasons, in one row: the next reason passes over what an earlier one has taken
    row = F.struct("i", "turn", "reason", "score", F.col(key).alias("key"))
    line = best.agg(F.array_sort(F.collect_list(row)).alias("line"))
    kind = line.schema["line"].dataType

    def taken(some: Column, x: Column) -> Column:
        return F.when(F.exists(some, lambda y: (y["i"] == x["i"]) | (y["key"] == x["key"])), some).otherwise(F.concat(some, F.array(x)))

    return line.select(F.explode(F.aggregate("line", F.array().cast(kind), taken)).alias("x")).select(F.col("x.key").alias(key), "x.reason", "x.score")
