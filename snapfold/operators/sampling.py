"""Reproducible samples: seeded hashes instead of chance, whatever the order of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Parts of a group in each of which its first members are looked for.
PARTS = 64


def sample_key(seed: str, domain: str, value: str) -> Column:
    """SHA-256 of the JSON array of seed, domain and value, which no two triples share."""
    return F.sha2(F.to_json(F.array(F.lit(seed), F.lit(domain), F.col(value).cast("string"))), 256)


def distinct_candidates(rows: DataFrame, key: str) -> DataFrame:
    """One row a key: the least by its JSON text, so that the order of the input doesn't matter."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.min_by(whole, F.to_json(whole)).alias("r")).select("r.*")


def members(rows: DataFrame, key: str, popular: str, recent: str, group: str, size: int, seed: str, version: int = 2) -> DataFrame:
    """A third by popularity, a third of the rest by recency, and others, one group after another in seeded turns, until ``size``.

    Version 1 takes the hash of the bare id within a group, and the groups in lexical order.
    """
    third = size // 3
    top = rows.orderBy(F.desc(popular), key).limit(third)
    rest = rows.join(top.select(key), key, "left_anti")
    late = rest.where(F.col(recent).isNotNull()).orderBy(F.desc(recent), key).limit(third)
    rest = rest.join(late.select(key), key, "left_anti")
    own = sample_key(seed, "repository", key) if version == 2 else F.sha2(F.col(key).cast("string"), 256)
    of_group = sample_key(seed, "organization", group) if version == 2 else F.col(group).cast("string")
    # no group can give more than ``size``: its first ones are found in parts before they meet, so a large group is no large task
    others = rest.select(key, group, own.alias("_own"), of_group.alias("_group")).withColumn("_part", F.pmod(F.xxhash64(key), F.lit(PARTS)))
    others = others.withColumn("_turn", F.row_number().over(Window.partitionBy(group, "_part").orderBy("_own", key))).where(F.col("_turn") <= size)
    others = others.withColumn("_turn", F.row_number().over(Window.partitionBy(group).orderBy("_own", key))).where(F.col("_turn") <= size)
    label = lambda df, i, n: df.select(key, F.lit(n).alias("stratum"), F.lit(i).alias("_i"), F.lit(0).alias("_turn"), F.lit("").alias("_group"))
    spread = others.select(key, F.lit("remaining").alias("stratum"), F.lit(2).alias("_i"), "_turn", "_group")
    chosen = label(top, 0, "popular").unionByName(label(late, 1, "recent")).unionByName(spread)
    return chosen.orderBy("_i", "_turn", "_group", key).limit(size).select(key, "stratum")


def population(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Count and digest of each group's candidates, whatever their order.

    Ids are dealt by their own hash to 4,096 parts; a part's digest is of its sorted ids, the group's of its parts' in order, so
    that no group's ids ever meet in one row.
    """
    text = F.col(key).cast("string")
    parts = rows.groupBy(group, F.substring(F.sha2(text, 256), 1, 3).alias("_part")).agg(F.count("*").alias("_n"), F.sha2(F.array_join(F.array_sort(F.collect_list(text)), "\n"), 256).alias("_d"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_part", "_d"))), lambda x: x["_d"])
    return parts.groupBy(group).agg(F.sum("_n").alias("n"), F.sha2(F.array_join(ordered, "\n"), 256).alias("digest"))


def work_list(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Wanted ids without a terminal status."""
    return wanted.select(key).distinct().join(done.select(key), key, "left_anti")
