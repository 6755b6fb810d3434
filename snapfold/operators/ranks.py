"""Values at exact ranks of groups, without a group's values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

#: Cells of a histogram, and how many distinct values of a group may be looked at one by one.
CELLS, FEW = 1024, 10_000


def _cell(value: Column, low: Column, high: Column) -> Column:
    """The cell of a value between two others, never falling as values grow; NaN is above all numbers, as in Spark's order."""
    share = (value - low) / (high - low) * (CELLS - 2)
    inner = F.when(F.isnan(share), 1).otherwise(F.least(F.greatest(F.floor(share), F.lit(0)), F.lit(CELLS - 3)) + 1)
    return F.when(value == low, 0).when(F.isnan(value) | (value == high), CELLS - 1).otherwise(inner).cast("int")


def at_ranks(rows: DataFrame, keys: list[str], value: str, share: float, few: int = FEW) -> DataFrame:
    """keys, low, high: the values right below and above ``share`` of the way through each group's sorted values, nulls left out.

    Equal values are counted first, so that only distinct ones go on. While a group still has more than ``few`` of them between
    the bounds of a rank, a histogram of ``CELLS`` cells narrows the bounds down to the cell that holds it. Bounds are a row a
    group and rank, written to the shared folder, since each round reads them twice; rounds are few as each divides the range.
    The last step ranks at most ``few`` values a group.
    """
    shared_dir(rows.sparkSession)
    told = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    all_of = told.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_kinds"))
    place = (F.col("_n") - 1) * F.lit(share)
    bounds = all_of.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place))))).select(*keys, "_rank", F.lit(0).cast("long").alias("_below"), "_low", "_high", "_kinds")
    while (bounds := bounds.checkpoint()).where(F.col("_kinds") > few).limit(1).count():
        wide = (F.col("_kinds") > few) & (F.col("_low") < F.col("_high"))
        near = told.join(bounds.where(wide), keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))
        cells = near.groupBy(*keys, "_rank", "_below", _cell(F.col("_v"), F.col("_low"), F.col("_high")).alias("_cell")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_kinds"))
        before = F.col("_below") + F.coalesce(F.sum("_c").over(Window.partitionBy(*keys, "_rank").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cells = cells.withColumn("_before", before).where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
        narrowed = cells.select(*keys, "_rank", F.col("_before").alias("_below"), "_low", "_high", "_kinds")
        bounds = bounds.where(~wide).unionByName(narrowed)
    near = told.join(bounds, keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))
    upto = F.col("_below") + F.sum("_c").over(Window.partitionBy(*keys, "_rank").orderBy("_v"))
    hit = near.withColumn("_upto", upto).where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_c") <= F.col("_rank")))
    return hit.groupBy(*keys).agg(F.min_by("_v", "_rank").alias("low"), F.max_by("_v", "_rank").alias("high"))


def medians(rows: DataFrame, keys: list[str], value: str, name: str, few: int = FEW) -> DataFrame:
    """keys and the exact median of each group that has a value, as ``F.median`` gives it."""
    found = at_ranks(rows, keys, value, 0.5, few)
    return found.select(*keys, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((F.col("low") + F.col("high")) / 2).alias(name))
