"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts at the same places.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of input that a bucket is meant for.
BUCKET = 64 << 20

#: What the operators have written in this process and not released: folders, and tables of the warehouse.
_FOLDERS: list[str] = []
_TABLES: list[str] = []


def made() -> set[str]:
    """The folders and tables that operators have written and not released."""
    return {*_FOLDERS, *_TABLES}


def release(spark: SparkSession, names: set[str] | None = None) -> None:
    """Deletes what operators have written, or of it what is named; only once nothing that comes from it will be read again."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name in [t for t in _TABLES if names is None or t in names]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _TABLES.remove(name)
    for name in [f for f in _FOLDERS if names is None or f in names]:
        path = hadoop.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _FOLDERS.remove(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; where that is unset a temporary one, in local mode only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, deleted by ``release``."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def written(df: DataFrame, label: str, compression: str = "zstd", by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, in folders of column ``by`` if given, and read again: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: str) -> F.Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def bucketed(df: DataFrame, key: str, least: int) -> DataFrame:
    """``df`` as a table in the warehouse, bucketed by ``key``: joins on it need no shuffle of this side.

    A bucket is read by one task: there are ``least``, and more where the files that ``df`` comes from have above ``BUCKET`` bytes a bucket.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(n for n in sizes if n < 1 << 60)  # what isn't a file has no size that Spark knows
    name = f"rows_{uuid.uuid4().hex}"
    _TABLES.append(name)
    df.write.option("compression", "zstd").bucketBy(min(100_000, max(least, size // BUCKET)), key).saveAsTable(name)
    return df.sparkSession.table(name)


def positional(df: DataFrame, columns: list[str]) -> list:
    """Columns under names that clash with none an operator makes: _k0, _k1 and so on."""
    return [df[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(columns)]


#: Arrays that a task adds up for a place.
FAN = 64


def summed(parts: DataFrame, tasks: int, many: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(at, y) rows, ``y`` the bytes of float32 numbers, to the sum of the arrays of each ``at``; added up in ``tasks`` tasks.

    Where about ``many`` partitions give an array to each place, they are added as a tree, ``FAN`` partitions a task, so that no task
    reads more however many there are, and in an order that doesn't change between runs. The driver gets one array of each place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        kinds = pa.int64(), pa.int32(), pa.binary()
        one = lambda: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*now, total.tobytes()), kinds)], ["at", "part", "y"])
        for b in batches:
            for at, group, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                part = np.frombuffer(y.as_buffer(), np.float32)
                if (at, group) == now:
                    total += part
                    continue
                if now is not None:
                    yield one()
                now, total = (at, group), part.copy()
        if now is not None:
            yield one()

    level = parts.select("at", F.spark_partition_id().alias("part"), "y")
    while True:
        many = -(-many // FAN)
        dealt = level.select("at", (F.col("part") % many).alias("group"), "y", "part").repartition(tasks * many, "at", "group").sortWithinPartitions("at", "group", "part")
        level = dealt.select("at", "group", "y").mapInArrow(run, "at long, part int, y binary")
        if many == 1:
            break
    for r in level.toLocalIterator():
        yield r["at"], np.frombuffer(bytes(r["y"]), np.float32)
