"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage owns the scratch data that it makes. It goes when a stage begins whose documents don't come from it, so stages may be
chained without writing, but a result must be read or written before stages on other documents begin; results of other operators
are left alone. ``run`` deletes a stage's output once the next one is written.

Stages treat rows one by one: null texts and ids, repeated rows and clashing column names are those of the operators' docstrings,
and an empty table gives an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm import decontam, langid, mixing, simhash, suffixes
from snapfold.llm.common import made, release, shared_dir, written
from snapfold.session import importable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What the stages so far have written.
_OWNED: set[str] = set()


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        read = docs.inputFiles() if _OWNED & made() else []
        # names are unique, so a file that is read tells which of them it is of
        done = {x for x in _OWNED if not any(x.rsplit("/", 1)[-1] in f for f in read)}
        release(spark, done)
        _OWNED.difference_update(done)
        before = made()
        try:
            return work(spark, docs, sf_dir)
        finally:
            _OWNED.update(made() - before)

    return run


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network tells; the rest goes."""
    return langid.accepted(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.near_copies(docs, k=5, similarity=0.8)


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words of 50-word strings that also start elsewhere; n_chars follows the text."""
    out = suffixes.texts_without_passages(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark or a paraphrase of one.

    Each row is judged by itself: rows of equal or null doc_id go or stay by their own texts.
    """
    row = "_row" + "_" * max(map(len, docs.columns))
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    hits = decontam.contaminated(rows.select(F.col(row).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias(row)).distinct()
    # written, so that Spark knows their size when it chooses how to join
    hits = written(hits, "hits")
    return rows.join(hits, row, "left_anti").select(*docs.columns)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of every document, with what the mix takes of it."""
    return mixing.mix(docs, mixing.WEIGHTS, mixing.BUDGET, mixing.MAX_EPOCHS, mixing.SEED)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
]

#: SQL can't express the stages; they are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, _OWNED)
        _OWNED.clear()
        if before:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
