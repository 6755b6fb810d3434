"""Canonical rows, first sightings and revisions: one row out of many, by stated precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def precedence(source: str, order: list[str]) -> Column:
    """Rank of a source in ``order``; sources not named come last."""
    ranks = F.create_map(*[x for i, s in enumerate(order) for x in (F.lit(s), F.lit(i))])
    return F.coalesce(F.try_element_at(ranks, F.col(source)), F.lit(len(order)))


def canonical(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in ``order``, which must be total for a stable result."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def first_seen(rows: DataFrame, key: str, day: str, rank: str, source: str) -> DataFrame:
    """The least (day, precedence, source) of each key: a tie on the day goes to the stronger source."""
    seen = F.min(F.struct(day, rank, source))
    return rows.groupBy(key).agg(seen.alias("f")).select(key, F.col(f"f.{day}").alias("first_day"), F.col(f"f.{source}").alias("first_source"))


def conflicts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose rows of equal precedence differ; exact repeats are no conflict."""
    return rows.groupBy(*keys).agg(F.count_distinct(value).alias("n_values"), F.count("*").alias("n_rows")).where("n_values > 1")


def latest_batch(rows: DataFrame, batch: list[str], fetched: str) -> DataFrame:
    """Rows of each batch's newest revision; rows that it lacks vanish, whatever older revisions held."""
    newest = rows.groupBy(*batch).agg(F.max(fetched).alias("_newest"))
    return rows.join(newest, batch).where(F.col(fetched) == F.col("_newest")).drop("_newest")


def without_repeats(rows: DataFrame, keys: list[str], order: list, value: str) -> DataFrame:
    """Rows whose value differs from the one before; a return to an older value is a new row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("_same", F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1))
    return marked.where("not _same").drop("_same")


def overlay(rows: DataFrame, keys: list[str], order: list, tagged: Column, tag: str) -> DataFrame:
    """Canonical rows that take ``tag`` from the last row of their key that carries one, as losing rows may."""
    w = Window.partitionBy(*keys)
    with_tag = rows.withColumn(tag, F.max_by(F.when(tagged, F.col(tag)), F.when(tagged, F.struct(*[o for o in order]))).over(w))
    return canonical(with_tag, keys, order)


def strict_canonical(rows: DataFrame, keys: list[str], source: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Canonical rows by precedence of their source, and the violations: (keys, source) whose rows differ, in a losing source too.

    Rows that are equal as a whole are one. A key with a violation has no canonical row.
    """
    whole = F.struct(*[c for c in rows.columns])
    kinds = rows.groupBy(*keys, source).agg(F.count_distinct(F.to_json(whole, {"ignoreNullFields": "false"})).alias("n_kinds"), F.any_value(whole).alias("_row"))
    bad = kinds.where("n_kinds > 1").select(*keys, source, "n_kinds")
    first = kinds.groupBy(*keys).agg(F.max("n_kinds").alias("_worst"), F.min_by("_row", precedence(source, order)).alias("_row")).where("_worst = 1")
    return first.select("_row.*"), bad


def latest(rows: DataFrame, key: str, at: str, order: list, day: str, cutoff: Column | None = None) -> DataFrame:
    """The newest row of each key up to a cutoff, ties by ``order``, with the number of its distinct days up to then; one pass, one shuffle."""
    known = rows if cutoff is None else rows.where(F.col(at) <= cutoff)
    newest = F.min_by(F.struct(*rows.columns), F.struct((-F.unix_micros(F.col(at).cast("timestamp"))).alias("_at"), *order))
    return known.groupBy(F.col(key).alias("_key")).agg(newest.alias("_r"), F.count_distinct(day).alias("n_days")).select("_r.*", "n_days")


def latest_request(manifests: DataFrame, label: str, fetched: str, wanted: Column) -> DataFrame:
    """The newest manifest of each label among those whose request is ``wanted``."""
    whole = F.struct(*manifests.columns)
    return manifests.where(wanted).groupBy(F.col(label).alias("_label")).agg(F.max_by(whole, F.struct(fetched, F.to_json(whole))).alias("_m")).select("_m.*")
