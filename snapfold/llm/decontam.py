"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of ``2 * STRIDE`` words that overlap by half. Their TF-IDF vectors, over ``FEATURES`` hashed
words and document frequencies of the whole corpus, are projected on latent spaces. Items come in blocks of at most ``ITEMS``,
fewer than the ``RANK`` dimensions, and each block has a space of its own, so that the search of an item is as good among
a million items as among a hundred. Every passage of every text takes part in the spaces: one pass adds it, with a random sign, to
one of ``SKETCH`` rows (a randomised SVD by sparse projection); tasks' rows are added up in executors by ranges of features, and one matrix of fixed
size, ``SKETCH x FEATURES``, comes to the driver. A space is the singular vectors of it and of the block's items. A second pass over the corpus then holds every passage against all items of
``TOGETHER`` blocks by cosine. A candidate's neighbourhood is checked by the longest common subsequence of words with the
item, which must hold ``LCS`` of the item in a stretch at most ``STRETCH`` times as long, and ``ANSWER`` of the item's
answer (the answer column, else its last quarter).

Words are runs of letters, digits and bytes outside ASCII, lower-cased; so punctuation and case don't hide a copy.

Defined cases: null or empty texts and items match nothing; items with equal id are each searched, and a text gets the best of
them; repeated rows and equal doc_ids give one row an item and doc_id; a null id stays null; empty tables give an empty
result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import summed, written
from .suffixes import Rolling, _mixed

STRIDE, FEATURES, RANK, SKETCH = 32, 16384, 256, 256
#: Bounds: items of a block, blocks searched in one pass, bytes laid end to end.
ITEMS, TOGETHER, CHUNK = 240, 4, 1 << 18
#: Features of a range that is summed in an executor.
RANGE = 1024
COSINE, LCS, STRETCH, ANSWER, SEED = 0.25, 0.7, 1.5, 0.5, 3
#: Weight of an item in a space, and of all passages of the corpus together, however many there are.
ITEM_WEIGHT, CORPUS_WEIGHT = 1000.0, 24000.0
_BREAK = np.array([not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b > 127) for b in range(256)])


def words(texts: list[bytes | None], rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts laid end to end, and the number of words before each text, with the end."""
    data = np.frombuffer(b" ".join(t or b"" for t in texts) + b" ", np.uint8)
    starts = np.cumsum([0, *(len(t or b"") + 1 for t in texts[:-1])])
    gap = _BREAK.take(data)
    edge = np.diff(np.r_[True, gap, True].astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    rolling.load(data)
    return _mixed(rolling.of(0, first, last)), np.append(np.searchsorted(first, starts), len(first))


def chunks(b: pa.RecordBatch, column: int) -> Iterator[tuple[int, list]]:
    values, at = b.column(column).to_pylist(), 0
    while at < len(values):
        stop, size = at, 0
        while stop < len(values) and (stop == at or size < CHUNK):
            size += len(values[stop] or b"")
            stop += 1
        yield at, values[at:stop]
        at = stop


def features(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(FEATURES)).astype(np.int64)


def passages(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of STRIDE words: first word of each, text of each, and whether it has a next one in its text."""
    sizes = np.diff(bounds)
    n = -(-sizes // STRIDE)
    text = np.repeat(np.arange(len(sizes)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(bounds[:-1], n) + within * STRIDE, text, within + 1 < n[text]


def in_passages(rows: np.ndarray, first: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Sums over each passage of what is given for each word."""
    block = np.add.reduceat(rows, first, axis=0)
    out = block.copy()
    out[:-1][more[:-1]] += block[1:][more[:-1]]
    return out


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int, int]:
    """How many documents have each hashed word, how many documents there are, and by how many tasks they were read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, df = Rolling(), np.zeros(FEATURES + 2, np.int64)
        df[FEATURES + 1] = 1
        for b in batches:
            for _, texts in chunks(b, 0):
                h, bounds = words(texts, rolling)
                owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
                df[:FEATURES] += np.bincount(np.unique(owner * FEATURES + features(h)) % FEATURES, minlength=FEATURES)
                df[FEATURES] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], ["f", "n"])

    rows = docs.select(F.lower("text").cast("binary")).mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(FEATURES + 2, np.int64)
    df[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return df[:FEATURES], int(df[FEATURES]), int(df[FEATURES + 1])


def corpus_sketch(docs: DataFrame, idf: np.ndarray, tasks: int) -> np.ndarray:
    """SKETCH x FEATURES: the unit TF-IDF vectors of all passages of (doc_id, text), each added with a random sign to a random row.

    Row and sign are a hash of the words, the id and the place, so that copies don't add up to more than their number and reruns agree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, total = Rolling(), np.zeros(SKETCH * FEATURES, np.float32)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            for at, texts in chunks(b, 1):
                h, bounds = words(texts, rolling)
                if not len(h):
                    continue
                f = features(h)
                first, text, more = passages(bounds)
                norm = np.sqrt(in_passages(idf[f].astype(np.float64) ** 2, first, more))
                draw = _mixed(np.add.reduceat(h, first) ^ _mixed(ids[at + text] + np.uint64(SEED)) ^ (first - bounds[text]).astype(np.uint64))
                row = (draw % np.uint64(SKETCH)).astype(np.int64) * FEATURES
                weight = np.where(draw >> np.uint64(63), 1.0, -1.0) / np.maximum(norm, 1e-9)
                # a word's passages: its block's, and the one before
                block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(f))))
                np.add.at(total, row[block] + f, (weight[block] * idf[f]).astype(np.float32))
                two = np.flatnonzero(np.r_[False, more[:-1]][block])
                before = block[two] - 1
                np.add.at(total, row[before] + f[two], (weight[before] * idf[f[two]]).astype(np.float32))
        total = total.reshape(SKETCH, FEATURES)
        for at in range(0, FEATURES, RANGE):
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total[:, at : at + RANGE].tobytes()], pa.binary())], ["at", "y"])

    out = np.zeros((SKETCH, FEATURES), np.float32)
    rows = docs.select(F.xxhash64("doc_id").alias("id"), F.lower("text").cast("binary").alias("text"))
    for at, part in summed(rows.mapInArrow(run, "at long, y binary"), FEATURES // RANGE, tasks):
        out[:, at : at + RANGE] = part.reshape(SKETCH, -1)
    return out * np.float32(np.sqrt(CORPUS_WEIGHT) / max(float(np.linalg.norm(out)), 1e-9))


def latent_space(sketch: np.ndarray, items: list[bytes], idf: np.ndarray) -> np.ndarray:
    """FEATURES x RANK basis (half precision) of the corpus, by its sketch, and of the TF-IDF vectors of a block's items."""
    rolling, own = Rolling(), np.zeros((len(items), FEATURES), np.float32)
    for i, text in enumerate(items):
        f = features(words([text], rolling)[0])
        v = np.bincount(f, minlength=FEATURES) * idf
        own[i] = v * (np.sqrt(ITEM_WEIGHT) / max(float(np.linalg.norm(v)), 1e-9))
    y = np.concatenate([sketch, own])
    # singular vectors by the small Gram matrix
    scale, turn = np.linalg.eigh((y @ y.T).astype(np.float64))
    kept = np.flatnonzero(scale > 1e-6 * max(scale.max(), 1e-30))[::-1][:RANK]
    if not len(kept):
        return np.zeros((FEATURES, 1), np.float16)
    return np.ascontiguousarray((y.T @ (turn[:, kept] / np.sqrt(scale[kept])).astype(np.float32)).astype(np.float16))


def lcs(masks: dict[int, int], n: int, other: list[int]) -> int:
    """Longest common subsequence of an item of n words, given as the bits of each word's places, and ``other``."""
    full = (1 << n) - 1
    v = full
    for t in other:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


class Item:
    def __init__(self, key: int | None, hashes: list[int], answer: list[int]):
        self.key, self.n = key, len(hashes)
        self.masks, self.answer = self._bits(hashes), self._bits(answer)
        self.n_answer = len(answer)

    @staticmethod
    def _bits(hashes: list[int]) -> dict[int, int]:
        out: dict[int, int] = {}
        for i, t in enumerate(hashes):
            out[t] = out.get(t, 0) | 1 << i
        return out

    def found(self, near: list[int]) -> float:
        """Share of the item in its best stretch of ``near``; 0 if that or the answer's is too small."""
        need = LCS * self.n
        # at most n - need words are missing
        if len(self.masks.keys() & set(near)) < len(self.masks) - (self.n - need):
            return 0.0
        if lcs(self.masks, self.n, near) < need:
            return 0.0
        width = max(self.n, int(STRETCH * self.n))
        best, where = 0, near
        # the best stretch begins with a word of the item
        for at in (i for i, t in enumerate(near[: len(near) - int(np.ceil(need)) + 1]) if t in self.masks):
            part = near[at : at + width]
            if (got := lcs(self.masks, self.n, part)) > best:
                best, where = got, part
        if best < need or lcs(self.answer, self.n_answer, where) < ANSWER * self.n_answer:
            return 0.0
        return best / self.n


class Block:
    """Items of a block, and their unit vectors in its space."""

    def __init__(self, items: list[tuple], idf: np.ndarray, basis: np.ndarray):
        self.basis, self.items, vectors, rolling = basis, [], [], Rolling()
        for key, text, answer in items:
            h, _ = words([text], rolling)
            a, _ = words([answer], rolling)
            if len(h):
                hashes = h.tolist()
                self.items.append(Item(key, hashes, a.tolist() or hashes[-max(1, len(hashes) // 4) :]))
                f = features(h)
                v = (basis[f].astype(np.float32) * idf[f][:, None]).sum(0)
                vectors.append(v / max(float(np.linalg.norm(v)), 1e-9))
        self.queries = np.array(vectors, np.float32).reshape(-1, basis.shape[1])


def matches(docs: DataFrame, blocks: list[Block], idf: np.ndarray, cosine: float = COSINE) -> DataFrame:
    """(item_id, doc_id, similarity, lcs) of the items of a few blocks, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what a word adds to a passage's product with each item
        rolling, tables = Rolling(), [(x.basis.astype(np.float32) * idf[:, None]) @ x.queries.T for x in blocks]
        for b in batches:
            out: dict[tuple, tuple] = {}
            for at, texts in chunks(b, 1):
                h, bounds = words(texts, rolling)
                if not len(h):
                    continue
                f = features(h)
                first, text, more = passages(bounds)
                norm = np.maximum(np.sqrt(in_passages(idf[f] ** 2, first, more)), 1e-9)
                for k, (block, table) in enumerate(zip(blocks, tables)):
                    if not block.items:
                        continue
                    x = in_passages(table.take(f, axis=0), first, more)
                    for i in range(0, len(x), 4096):
                        score = x[i : i + 4096] / norm[i : i + 4096, None]
                        for p, q in zip(*np.nonzero(score >= cosine)):
                            item, row = block.items[q], at + int(text[i + p])
                            place = int(first[i + p])
                            lo, hi = max(int(bounds[text[i + p]]), place - item.n), min(int(bounds[text[i + p] + 1]), place + 2 * STRIDE + item.n)
                            if share := item.found(h[lo:hi].tolist()):
                                key = row, k, int(q)
                                old = out.get(key, (0.0, 0.0))
                                out[key] = max(old[0], min(1.0, float(score[p, q]))), max(old[1], share)
            ids = b.column(0).to_pylist()
            cols = [blocks[k].items[q].key for _, k, q in out], [ids[r] for r, _, _ in out], [v[0] for v in out.values()], [v[1] for v in out.values()]
            kinds = pa.int64(), pa.int64(), pa.float64(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["item_id", "doc_id", "similarity", "lcs"])

    return docs.select(F.col("doc_id").cast("long"), F.lower("text").cast("binary")).mapInArrow(run, "item_id long, doc_id long, similarity double, lcs double")


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(item_id, doc_id, similarity, lcs): documents that hold an item or a paraphrase of it."""
    answer = F.lower("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long"), F.lower("text").cast("binary").alias("text"), answer.cast("binary").alias("answer")).distinct()
    df, n, tasks = document_frequencies(docs)
    # words that a good part of the corpus has count for little: a fifth of the largest weight is taken off
    idf = np.maximum(0.05, np.log((n + 1) / (df + 1)) - 0.2 * np.log(n + 1)).astype(np.float32)
    sketch = corpus_sketch(docs, idf, tasks)
    n_blocks = max(1, -(-items.count() // (ITEMS * 15 // 16)))
    dealt = written(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)).cast("int")), "items", by="block")
    out, held = None, []
    for k in range(n_blocks):
        own = dealt.where(F.col("block") == k)
        rows = sorted(own.select("item_id", "text", "answer").collect(), key=lambda r: (r[0] is None, r[0] or 0, bytes(r[1] or b""), bytes(r[2] or b"")))
        basis = latent_space(sketch, [bytes(r[1] or b"") for r in rows], idf)
        held.append(Block([(r[0], bytes(r[1] or b""), bytes(r[2] or b"")) for r in rows], idf, basis))
        if len(held) == TOGETHER or k == n_blocks - 1:
            # written, so that no more than one pass's spaces are held
            found = matches(docs, held, idf, cosine)
            found = written(found, "matches") if n_blocks > TOGETHER else found
            out, held = found if out is None else out.unionByName(found), []
    return out.groupBy("item_id", "doc_id").agg(F.max("similarity").alias("similarity"), F.max("lcs").alias("lcs"))


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
