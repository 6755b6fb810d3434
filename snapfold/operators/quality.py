"""Data quality: profiles, comparisons and violation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(rows: DataFrame, name: str, columns: list[str], keys: list[str]) -> DataFrame:
    """Rows, excess duplicates of a key and the null rate of each column, one row a column."""
    sums = rows.agg(F.count("*").alias("n"), *[F.round(F.avg(F.col(c).isNull().cast("int")), 6).alias(c) for c in columns])
    extra = rows.groupBy(*keys).count().agg(F.coalesce(F.sum(F.greatest(F.col("count") - 1, F.lit(0))), F.lit(0)).alias("n_excess"))
    long = sums.unpivot(["n"], columns, "column_name", "null_rate")
    return long.join(F.broadcast(extra)).select(F.lit(name).alias("table_name"), "column_name", F.col("n").alias("n_rows"), "null_rate", "n_excess")


def inventory(before: DataFrame, after: DataFrame, key: str, digest: str, alternate: str | None = None) -> DataFrame:
    """What is missing, added, changed, or changed to an allowed alternate form."""
    a, b = before.alias("a"), after.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    allowed = F.col(f"a.{alternate}") == F.col(f"b.{digest}") if alternate else F.lit(False)
    state = (
        F.when(F.col(f"b.{key}").isNull(), "missing")
        .when(F.col(f"a.{key}").isNull(), "added")
        .when(F.col(f"a.{digest}") == F.col(f"b.{digest}"), "same")
        .when(allowed, "alternate")
        .otherwise("changed")
    )
    return both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), state.alias("state")).where("state <> 'same'")


#: Buckets whose digests are compared before any rows are.
BUCKETS = 1 << 14


def _hashes(rows: DataFrame) -> DataFrame:
    """``rows`` with two independent hashes of each whole row and the bucket that the first one deals it to."""
    whole = [F.col(f"`{c}`") for c in rows.columns]
    out = rows.withColumns({"_h": F.xxhash64(*whole), "_g": F.xxhash64(F.lit(1), *whole)})
    return out.withColumn("_bucket", F.pmod("_h", F.lit(BUCKETS)).cast("int"))


def bag_digests(rows: DataFrame) -> DataFrame:
    """Count and sums of row hashes of each bucket: equal bags have equal digests, in whatever order and files their rows are."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return _hashes(rows).groupBy("_bucket").agg(F.count("*").alias("n"), wide("_h").alias("h"), wide("_g").alias("g"))


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, counted as often as they are too many; no row if the bags are equal.

    Digests of buckets are compared first, which is one aggregation a side of rows that stay where they are. Only rows of buckets
    that differ are then shuffled; where none does, nothing is. Columns are matched by their places, and maps can't be compared.
    """
    b = b.toDF(*a.columns)
    both = bag_digests(a).alias("a").join(bag_digests(b).alias("b"), "_bucket", "full_outer")
    unequal = both.where(~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h")) & F.col("a.g").eqNullSafe(F.col("b.g")))).select("_bucket")
    # at most BUCKETS small numbers
    left = lambda x: _hashes(x).join(F.broadcast(unequal), "_bucket", "left_semi")
    counted = left(a).withColumn("_s", F.lit(1)).unionByName(left(b).withColumn("_s", F.lit(-1)))
    whole = [F.col(f"`{c}`") for c in a.columns]
    more = counted.groupBy(*whole).agg(F.sum("_s").alias("_s")).where("_s <> 0")
    side = F.when(F.col("_s") > 0, "left").otherwise("right").alias("side")
    return more.select(*whole, side, F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_s"))).alias("_i")).drop("_i")


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return rows.select(key, F.explode(broken).alias("rule"))


def gate(found: DataFrame, fail: bool = True) -> DataFrame:
    """Counts of violations by rule; raises if there are any and ``fail`` is set."""
    counts = found.groupBy("rule").agg(F.count("*").alias("n"))
    if fail and (first := counts.first()):
        raise ValueError(f"{first['n']} violations of {first['rule']}")
    return counts


def extract_profile(rows: DataFrame, day: str, leg: str, key: str) -> DataFrame:
    """Rows, distinct keys and repeats within the leg, for each day and leg; leg ``all`` has the keys of the day over all legs."""
    each = rows.groupBy(day, leg, key).agg(F.count("*").alias("_n"))
    by_leg = each.groupBy(day, leg).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum(F.col("_n") - 1).alias("n_repeats"))
    of_day = each.groupBy(day, key).agg(F.sum("_n").alias("_n")).groupBy(day).agg(F.lit("all").alias(leg), F.sum("_n").alias("n_rows"), F.count("*").alias("n_keys"), F.lit(0).cast("long").alias("n_repeats"))
    return by_leg.unionByName(of_day)


def build_summary(tables: dict[str, DataFrame], days: DataFrame, day: str, found: DataFrame, most: int = 100) -> DataFrame:
    """One row, as a build reports itself: rows of each table, first and last day, follow-up, and how many findings, with the first of them."""
    counts = None
    for name, rows in tables.items():
        one = rows.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    sizes = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("rows"))
    span = days.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).withColumn("maximum_followup_days", F.date_diff("last_day", "first_day"))
    some = found.orderBy(*found.columns).limit(most).agg(F.array_sort(F.collect_list(F.struct(*found.columns))).alias("findings"))
    total = found.agg(F.count("*").alias("n_findings"))
    return sizes.join(F.broadcast(span)).join(F.broadcast(total)).join(F.broadcast(some))
