"""How the driver's tables stand for snapshots: a user is an entity, an event's type the source that saw it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import precedence

#: Sources from the strongest to the weakest.
TYPES = ["purchase", "signup", "error", "click", "view"]

EVENTS_SQL = """WITH e AS (SELECT *, ts::DATE AS day, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 WHEN 'view' THEN 4 ELSE 5 END AS rank FROM events)"""


def table(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def iso(day) -> F.Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_text(day: str) -> F.Column:
    return iso(day).alias(day)


def events(spark, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("day", F.to_date("ts")).withColumn("rank", precedence("event_type", TYPES))


def user_days(spark, d: str) -> DataFrame:
    """The canonical row of each user and day."""
    from ..operators.dedup import canonical

    return canonical(events(spark, d), ["user_id", "day"], ["rank", "ts", "event_id"])
