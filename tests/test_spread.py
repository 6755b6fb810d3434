"""Facts are dealt out in partitions that grow with their files, and no task gets all facts of a source."""

from pyspark.sql import functions as F

from snapfold import session
from snapfold.operators import deployments
from snapfold.plans import evidence


def test_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    spark.range(200_000).withColumn("k", F.xxhash64("id")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    monkeypatch.setattr(session, "PART", 100_000)
    dealt = session.spread(rows, "k")
    assert dealt.rdd.getNumPartitions() > 15 and dealt.count() == 200_000


def test_roll_up_is_not_dealt_out_by_source(spark, sf_dir):
    facts, runs = evidence._rows(spark, sf_dir), evidence._runs(spark, sf_dir)
    plan = deployments.roll_up(facts, runs, "key", "source", "snapshot", "day", "at", "target")._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "SortMergeJoin [source" in x]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = deployments.roll_up(facts, runs, "key", "source", "snapshot", "day", "at", "target")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for x in plan.splitlines() if "SortMergeJoin [source" in x]
