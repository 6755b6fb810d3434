"""What the engine asks of a session."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def importable(spark: SparkSession) -> SparkSession:
    """Adds the folder that holds this package to the Python path of tasks, for sessions that were started elsewhere.

    On a cluster whose machines lack that folder it does nothing; there the package must be installed or shipped.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which ``spark.checkpoint.dir`` names; unset, a temporary one in local mode only."""
    if not (path := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again, for what a plan would otherwise compute at each place that uses it."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of files that a partition is meant for.
PART = 8 << 20


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt out once by ``keys``, so that what groups by them or more needs no further shuffle.

    Partitions grow with the files that ``rows`` come from, so that a task's share doesn't; small inputs are left to Spark.
    """
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    n = sum(x for x in sizes if x < 1 << 60) // PART  # what isn't a file has no size that Spark knows
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, n), *keys) if n >= 8 else rows.repartition(*keys)
