r"""Ranked lexical search: term at a time, with a limit on accumulators that loses nothing.

Documents are tokenised once into a forward index of the items' terms (``written`` to the shared folder), which gives the
statistics of the whole collection. Each task then turns blocks of documents into postings and ranks every item in them: its
terms are taken from the rarest to the commonest; a document gets an accumulator when a term first meets it, until what the
terms still to come can add at most is below the k-th best partial score (of this block, or final of earlier ones of the
task): no document without an accumulator can then be among the best. The accumulators that are there are still updated by
every remaining term, so their scores are exact. The best of each task are ranked among tasks in two steps.

The most that a term can add is read off the postings of the block, so the limit is as tight as the block allows. Ties are by
document id, so creation stops only where the rest stays strictly below.

Items go in groups of at most ``GROUP`` terms (their number grows with the items, never with the documents); a group is
what is sent to every task, and the vocabulary and document frequencies that the driver holds are no larger. An item that has
more is a group of its own. A task holds a block of ``BLOCK`` postings at most, or those of one document, and the best of
each item so far.

Defined cases: a null or empty text has no terms, and its document isn't counted; a null item, or one without terms, has no
rows; each row of the items is an item of its own, whatever its id. Rows of equal document id are documents of their own;
null ids come after all others among equal scores. Scores of 0 are left out. Other columns are not looked at, and an empty
table of either kind gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Terms are runs of letters, digits and anything beyond ASCII; bytes of the rest become blanks, A-Z lower case.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
GROUP, BLOCK, BEST = 1 << 20, 1 << 21, 10
NONE = np.iinfo(np.int64).max


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def _items(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """Groups of (row, terms); the rows come one partition at a time."""
    group, size = [], 0
    for row, text in items.select("_item", "text").toLocalIterator():
        found = Counter(terms(text))
        if group and size + len(found) > GROUP:
            yield group
            group, size = [], 0
        if found:
            group.append((row, found))
            size += len(found)
    if group:
        yield group


def _forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Each document with a term: its id, its number of terms, and codes and frequencies of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes, codes, counts = [], [], [], []
            for at, text in zip(b.column(0), b.column(1)):
                words = terms(text.as_py())
                if not words:
                    continue
                found = Counter(map(vocabulary.get, words))
                found.pop(None, None)
                ids.append(at.as_py())
                sizes.append(len(words))
                codes.append(list(found))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(codes, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "n", "codes", "counts"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, codes array<int>, counts array<int>")


@dataclass
class Query:
    """An item: its codes from the rarest to the commonest, and how often it has each."""

    row: int
    codes: np.ndarray
    times: np.ndarray


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Postings:
    """The postings of a block, sorted by term, with what each adds to its document's score."""

    def __init__(self, docs: np.ndarray, sizes: np.ndarray, owners: np.ndarray, codes: np.ndarray, counts: np.ndarray, weights: np.ndarray, n: int, length: int) -> None:
        self.docs = docs
        order = np.argsort(codes, kind="stable")
        codes, self.owners, tf = codes[order], owners[order], counts[order].astype(np.int64)
        m = 25 + 75 * sizes * n // max(length, 1)
        self.adds = weights[codes] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.owners]))
        self.terms, starts = np.unique(codes, return_index=True)
        self.starts = np.append(starts, len(codes))
        self.most = np.maximum.reduceat(self.adds, starts) if len(codes) else self.adds
        self.scores, self.seen = np.zeros(len(docs), np.int64), np.zeros(len(docs), bool)

    def best(self, query: Query, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and scores of the documents that may be among the k best, and how many accumulators there were.

        ``floor``: the k-th best score so far; documents below it are left out.
        """
        at = np.searchsorted(self.terms, query.codes)
        there = at < len(self.terms)
        there[there] = self.terms[at[there]] == query.codes[there]
        at, times = at[there], query.times[there]
        rest = np.append(np.cumsum((times * self.most[at])[::-1])[::-1], 0)
        kept, bar = np.empty(0, np.int64), floor
        creating = True
        for i, (t, q) in enumerate(zip(at, times)):
            a, b = self.starts[t], self.starts[t + 1]
            owners, adds = self.owners[a:b], self.adds[a:b] * q
            if creating and len(kept) and rest[i] >= bar:
                bar = max(bar, _kth(self.scores[kept], k))
            creating = creating and rest[i] >= bar
            if creating:
                fresh = owners[~self.seen[owners]]
                self.seen[fresh] = True
                kept = np.append(kept, fresh)
                self.scores[owners] += adds
            elif not len(kept):
                break
            elif len(kept) * 8 < len(owners):
                # postings of a term are in order of the documents
                place = np.minimum(np.searchsorted(owners, kept), len(owners) - 1)
                hit = owners[place] == kept
                self.scores[kept[hit]] += adds[place[hit]]
            else:
                hit = self.seen[owners]
                self.scores[owners[hit]] += adds[hit]
        scores = self.scores[kept]
        self.scores[kept], self.seen[kept] = 0, False
        bar = max(1, floor, _kth(scores, k))
        fine = scores >= bar
        return kept[fine], scores[fine], len(kept)


def _top(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def _ranked(index: DataFrame, queries: list[Query], weights: np.ndarray, n: int, length: int, k: int) -> DataFrame:
    """The best of each item in each task."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Postings]:
        held, size = [], 0
        def built() -> Postings:  # noqa: E306
            t = pa.Table.from_batches(held).combine_chunks()
            docs = t["doc_id"].fill_null(NONE).to_numpy()
            lists = t["codes"].combine_chunks()
            owners = np.repeat(np.arange(len(docs)), np.diff(lists.offsets.to_numpy()))
            return Postings(docs, t["n"].to_numpy(), owners, lists.flatten().to_numpy(), t["counts"].combine_chunks().flatten().to_numpy(), weights, n, length)
        for b in batches:  # noqa: E306
            a = 0
            ends = np.cumsum(np.diff(b.column("codes").offsets.to_numpy()))
            while a < len(b):
                before = ends[a - 1] if a else 0
                z = max(a + 1, int(np.searchsorted(ends, before + BLOCK - size, side="right")))
                held.append(b.slice(a, z - a))
                size += int(ends[z - 1] - before)
                a = z
                if size >= BLOCK or a < len(b):
                    yield built()
                    held, size = [], 0
        if held:
            yield built()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for block in blocks(batches):
            for i, query in enumerate(queries):
                old = best.get(i)
                at, scores, _ = block.best(query, k, int(old[1][-1]) if old is not None and len(old[1]) == k else 0)
                if len(at):
                    docs = block.docs[at]
                    best[i] = _top(np.append(old[0], docs), np.append(old[1], scores), k) if old is not None else _top(docs, scores, k)
        for i, (docs, scores) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([queries[i].row] * len(docs), pa.int64()), pa.array([None if d == NONE else d for d in docs.tolist()], pa.int64()), pa.array(scores, pa.int64())], ["_item", "doc_id", "score"])

    return index.mapInArrow(run, "_item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """doc_id, text and item_id, text to item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    items = written(items.select("item_id", "text").withColumn("_item", F.monotonically_increasing_id()), "items")
    found = None
    for group in _items(items):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in group for t in c}))}
        index = written(_forward(docs, vocabulary), "forward")
        n, length = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        weights = np.zeros(len(vocabulary), np.int64)
        held = index.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.ln((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long")
        for code, one, w in held.select("code", "df", weight).toLocalIterator():  # a row a term of the group
            df[code], weights[code] = one, w
        queries = []
        for row, counted in group:
            codes = np.array([vocabulary[t] for t in counted], np.int64)
            times = np.array(list(counted.values()), np.int64)
            order = np.lexsort((codes, df[codes]))
            queries.append(Query(row, codes[order], times[order]))
        part = _ranked(index, queries, weights, n, length, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "_item long, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    # first among some tasks, then among all: no task gets the best of every other at once
    some = found.withColumn("_part", F.spark_partition_id() % 64)
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy("_item", "_part").orderBy(*order))).where(F.col("_n") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(items.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents), s AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark), it AS (SELECT q, unnest(t) AS term FROM i), iq AS (SELECT q, term, count(*) AS times FROM it GROUP BY ALL),
p AS (SELECT r, unnest(t) AS term FROM d), tf AS (SELECT r, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM iq) GROUP BY ALL),
st AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM s), w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * (SELECT nn FROM st) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf GROUP BY term),
m AS (SELECT r, doc_id, 25 + (75 * n * (SELECT nn FROM st)) // (SELECT ll FROM st) AS m FROM s),
c AS (SELECT q, r, any_value(doc_id) AS doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM tf JOIN iq USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k JOIN i USING (q) WHERE rank <= {BEST}
"""
