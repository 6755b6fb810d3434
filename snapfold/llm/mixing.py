"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight. A source is clamped at ``max_epochs`` times its
size, and what it cannot hold is shared again among the others by weight until no source is above its clamp. Each
document is then taken a whole number of times, and a seeded order of the documents decides who is taken once more, so
that the words taken from a source meet its target.

Defined cases: a null text has size 0 and is taken 0 times; a null source is one source, ordered last; a source of size
0 has target 0; repeated rows are rows of their own; an empty table gives an empty result; all columns are kept by
``mix`` unless they carry the name of one that it makes, which then replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import positional, word_count, written

#: The seeded order is cut in this many ranges, so that running totals never need a whole source in one task.
RANGES = 4096


def source_targets(sizes: DataFrame, weights: list[float], budget: float, max_epochs: float) -> DataFrame:
    """(source, source_size) to (source, source_size, weight, target).

    ``weights`` repeat over the sources in code point order, null last; ``budget`` is a share of all words. A source is
    clamped exactly if its clamp per weight is below the water level, so the rounds of resharing collapse to one
    pass over the sources in order of that ratio.
    """
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    order = everything.orderBy("ratio", "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * F.lit(float(budget))
    levels = ranked.withColumn("level", (total - before) / left)
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(everything)
    target = F.when(F.col("ratio") <= F.col("water"), F.col("cap")).otherwise(F.col("weight") * F.col("water"))
    return levels.withColumn("water", level).select(
        "source", "source_size", "weight", F.when(F.col("water").isNull(), F.col("cap")).otherwise(target).alias("target")
    )


def mix(docs: DataFrame, weights: list[float], budget: float = 1.5, max_epochs: float = 2.0, seed: int = 7, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all of them) with source, size, source_size, target, epochs and taken (words, repeats counted).

    ``epochs`` counts the whole repetitions; ``taken - epochs * size`` words come from one further, fractional one.
    """
    made = ("source", "size", "source_size", "target", "epochs", "taken")
    keep = tuple(c for c in dict.fromkeys(docs.columns if keep is None else keep) if c not in made)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    sized = docs.select(
        *positional(docs, list(keep)),
        "source",
        F.col("doc_id").alias("_id"),
        word_count("text").alias("size"),
        key.alias("_key"),
        F.conv(F.substring(key, 1, 3), 16, 10).cast("int").alias("_range"),
    )
    # words are counted once; everything below reads what is written here
    sized = written(sized, "sized")
    # partial sums per source and range of the seeded order: at most RANGES rows a source
    ranges = sized.groupBy("source", "_range").agg(F.sum("size").alias("_in_range"))
    sources = source_targets(ranges.groupBy("source").agg(F.sum("_in_range").alias("source_size")), weights, budget, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn(
        "_more", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")
    )
    running = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_in_range").over(running), F.lit(0)))
    placed = ranges.join(sources, ranges["source"].eqNullSafe(sources["source"])).select(
        ranges["source"], "_range", "_in_range", "_before", "source_size", "target", "epochs", "_more"
    )
    # a row for each source, so that no text is shuffled to learn what becomes of it: up to range _full all documents are taken once
    # more, and only the range in which a source's further words run out, _edge, needs the order of its documents
    inside = (F.col("_more") > F.col("_before")) & (F.col("_more") < F.col("_before") + F.col("_in_range"))
    whole = F.col("_more") >= F.col("_before") + F.col("_in_range")
    placed = placed.groupBy("source", "source_size", "target", "epochs", "_more").agg(
        F.max(F.when(whole, F.col("_range"))).alias("_full"), F.max(F.when(inside, F.col("_range"))).alias("_edge"), F.max(F.when(inside, F.col("_before"))).alias("_before")
    )
    placed = written(placed, "placed")
    s, p = sized.alias("s"), placed.alias("p")
    joined = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "source_size", "target", "epochs", "_more", "_full", "_edge", "_before")
    at_edge = F.col("_range").eqNullSafe(F.col("_edge"))
    within = Window.partitionBy("source", "_range").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.col("_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    edge = joined.where(at_edge).withColumn("_extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_more") - seen)))
    rest = joined.where(~at_edge).withColumn("_extra", F.when(F.col("_range") <= F.col("_full"), F.col("size")).otherwise(F.lit(0)))
    out = rest.unionByName(edge)
    return out.withColumn("taken", (F.col("epochs") * F.col("size") + F.col("_extra")).cast("long")).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *made)


def repetitions(mixed: DataFrame) -> DataFrame:
    """One row for each time that a document is taken, with ``words`` of it: its size, or fewer in the last, fractional one."""
    n: Column = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    rows = mixed.where(n > 0).withColumn("repetition", F.explode(F.sequence(F.lit(1), n)))
    return rows.withColumn("words", F.least(F.col("size"), F.col("taken") - (F.col("repetition") - 1) * F.col("size")))


#: Production parameters of the registered query.
WEIGHTS, BUDGET, MAX_EPOCHS, SEED = [3.0, 1.0, 2.0], 1.5, 2.0, 7


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, WEIGHTS, BUDGET, MAX_EPOCHS, SEED, ("doc_id",)).select("doc_id", "size", "source_size", "target", "taken", "source")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank,
         source_size * 2.0::DOUBLE AS cap FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM r),
q AS (
  SELECT *, cap / weight AS ratio,
         ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
l AS (SELECT arg_min(level, ratio) AS water FROM q WHERE level <= ratio),
t AS (
  SELECT source, source_size,
         CASE WHEN water IS NULL OR ratio <= water THEN cap ELSE weight * water END AS target FROM q, l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
x AS (SELECT *, floor(target - epochs * source_size + 0.5)::BIGINT AS more FROM e),
y AS (
  SELECT d.doc_id, d.source, d.size, x.source_size, x.target, x.epochs, x.more,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, more - seen)))::BIGINT AS taken, source FROM y
"""
