"""Edges between entities, with spans and statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spans(rows: DataFrame, source: str, target: str, day: str) -> DataFrame:
    return rows.groupBy(source, target).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_rows"))


def with_status(edges: DataFrame, known: DataFrame, lookups: DataFrame, target: str, status: str) -> DataFrame:
    """``resolved`` if the target is known, else the status of its lookup, else ``not_looked_up``."""
    there = known.select(target).distinct().withColumn("_there", F.lit(True))
    out = edges.join(there, target, "left").join(lookups, target, "left")
    return out.withColumn("status", F.when(F.col("_there"), "resolved").otherwise(F.coalesce(status, F.lit("not_looked_up")))).drop("_there", status)


def firsts_attached(rows: DataFrame, outer: str, inner: str, day: str) -> DataFrame:
    """Each row with the first day of its outer key and of the pair."""
    return rows.withColumn("first_outer", F.min(day).over(Window.partitionBy(outer))).withColumn("first_pair", F.min(day).over(Window.partitionBy(outer, inner)))


def spellings(words: DataFrame, word: str) -> DataFrame:
    """Original spellings of each lower-cased word, sorted, where there are several."""
    counted = words.groupBy(word).agg(F.count("*").alias("_n"))  # a frequent word is a number long before it is in a list
    out = counted.groupBy(F.lower(word).alias("canonical")).agg(F.array_sort(F.collect_list(word)).alias("s"), F.sum("_n").alias("n_rows"))
    return out.where(F.size("s") > 1).select("canonical", F.array_join("s", ",").alias("spellings"), "n_rows")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of two id sets, of their union and of their intersection."""
    both = a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    each = both.groupBy(key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return each.agg(F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"), F.count_if((F.col("in_a") + F.col("in_b")) == 2).alias("n_both"), F.count("*").alias("n_union"))


def flags(entities: DataFrame, key: str, links: dict[str, DataFrame]) -> DataFrame:
    """Entities with a column for each named set of links: whether any link has the entity's key."""
    out = entities
    for name, rows in links.items():
        there = rows.select(F.col(key).alias("_key")).distinct().withColumn(name, F.lit(True))
        out = out.join(there, out[key] == F.col("_key"), "left").drop("_key").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def references(tags: DataFrame, tag: str, canonical: Column, wanted: DataFrame, known: str) -> tuple[DataFrame, DataFrame]:
    """Original spellings of each wanted id, the id itself where none was found; and the distinct tags that give no id."""
    told = tags.select(F.col(tag).alias("raw"), canonical.alias("_id"))
    forms = told.where("_id is not null").distinct().groupBy("_id").agg(F.array_sort(F.collect_list("raw")).alias("_forms"))
    out = wanted.select(known).distinct().join(forms, F.col(known) == F.col("_id"), "left").select(known, F.coalesce("_forms", F.array(known)).alias("originals"))
    return out, told.where("_id is null and raw is not null").select("raw").distinct()


def coverage_counts(entities: DataFrame, key: str, sets: dict[str, DataFrame]) -> DataFrame:
    """(measure, n, rate): how many distinct entities there are, and how many, and what share of them, each named set reaches."""
    marked = flags(entities.select(key).distinct(), key, sets)
    sums = marked.agg(F.count("*").alias("_all"), *[F.count_if(n).alias(n) for n in sets])
    long = sums.unpivot(["_all"], list(sets), "measure", "n").select("measure", "n", F.round(F.try_divide(F.col("n").cast("double"), F.col("_all")), 6).alias("rate"))
    return sums.select(F.lit("entities").alias("measure"), F.col("_all").alias("n"), F.lit(1.0).alias("rate")).unionByName(long)


def status_histogram(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, status, n) of several status columns in one pass; a null status is ``unknown``."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("status")) for c in columns]))
    return rows.select(each.alias("s")).groupBy("s.field", "s.status").agg(F.count("*").alias("n"))
