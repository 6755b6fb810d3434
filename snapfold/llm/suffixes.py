"""Removal of long repeated byte strings: anchors route passages to shards, induced sorting of suffixes decides.

A byte goes if a string of ``size`` bytes over it also starts anywhere else. Each such string holds, at the same place
in every copy, the gram of ``GRAM`` bytes with the least hash among its grams; those grams are the anchors, about two in
``size - GRAM`` bytes. An anchor whose hash is alone has no copy and goes. Round every other anchor lies its context, the
bytes that a string with this anchor can hold. Contexts that are equal as a whole are repeated as a whole, which a 64-bit
hash of either next to the anchor's own tells; of the others of an anchor, one of each kind goes to a shard, its gram shrunk
to one symbol. There the suffix array of all contexts finds the strings that two places share. Nothing but these contexts
is sorted. A shard takes whole anchors, so its size is bounded only by the contexts of one anchor that differ (see
``induced.py`` for what of it is kept on disk). Texts are written once, bucketed by row, so that contexts and the remaining bytes
are read without a shuffle of all texts.

The same is done for strings of whole words, however they are spaced: a word is then a code of ``CODE`` bytes, a hash, and spans of codes
are cut out of the text as the words that they cover.

Defined cases: a null text is empty; texts below ``size`` bytes keep all; repeated rows are copies of each other; equal
or null doc_ids don't matter; an empty table gives an empty result; further columns are not looked at by the operator.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, positional, shared_dir, written
from .induced import suffix_array

SIZE, GRAM = 400, 336
#: Words of a passage, bytes of a word's code, and bytes by which a gram is shorter than a passage's codes.
PASSAGE, CODE, SLACK = 50, 6, 64
#: Bytes of contexts that a task sorts together; one anchor's contexts are never parted.
SHARD = 1 << 20
CHUNK = 1 << 20
_RNG = np.random.default_rng(400)
_BYTE = _RNG.integers(1, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Prefix sums that give the hash of any substring of a chunk."""

    def __init__(self, functions: int = 1):
        self.n, self.functions = 0, functions

    def load(self, data: np.ndarray) -> None:
        if len(data) + 1 > self.n:
            self.n = max(len(data) + 1, CHUNK * 2)
            self.pow = [_powers(b, self.n) for b in _BASE[: self.functions]]
        self.sums = []
        for k in range(self.functions):
            s = np.empty(len(data) + 1, np.uint64)
            s[0] = 0
            np.cumsum(_BYTE[k].take(data) * self.pow[k][0][: len(data)], out=s[1:])
            self.sums.append(s)

    def of(self, k: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[k][stop] - self.sums[k][start]) * self.pow[k][1][start]

    def grams(self, size: int) -> np.ndarray:
        s = self.sums[0]
        return _mixed((s[size:] - s[:-size]) * self.pow[0][1][: len(s) - size])


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours."""
    n = len(values)
    pad = -n % width
    op, fill = (np.minimum, np.iinfo(np.uint64).max) if least else (np.maximum, 0)
    v = np.concatenate([values, np.full(pad, fill, np.uint64)]).reshape(-1, width)
    front = op.accumulate(v, axis=1).ravel()
    back = op.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return op(back[:m], front[width - 1 : width - 1 + m])


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rolling: Rolling, size: int, gram: int) -> tuple:
    """Of texts laid end to end: hash, context's hash, text index, place in the context, context's start and stop in the text."""
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32))
    if len(data) < size:
        return none
    rolling.load(data)
    h = rolling.grams(gram)
    width = size - gram + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    stops = starts + sizes
    window = sliding(h, width, True)
    at = np.arange(len(window))
    window[stops[owner[: len(window)]] < at + size] = 0
    over = sliding(np.concatenate([np.zeros(width - 1, np.uint64), window, np.zeros(width - 1, np.uint64)]), width, False)
    place = np.flatnonzero((over == h) & (over > 0))
    own = owner[place]
    lo = np.maximum(place - (size - gram), starts[own])
    hi = np.minimum(place + size, stops[own])
    context = _mixed(rolling.of(0, lo, hi) ^ (rolling.of(1, lo, hi) * _M1) ^ ((place - lo) * 1000003 + (hi - lo)).astype(np.uint64))
    base = starts[own]
    return h[place].view(np.int64), context.view(np.int64), own, (place - lo).astype(np.int32), (lo - base).astype(np.int32), (hi - base).astype(np.int32)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words begin and end."""
    edge = np.diff(np.r_[True, _SPACE.take(data), True].astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def coded(texts: list[bytes | None], rolling: Rolling) -> list[bytes]:
    """Each text as the codes of its words."""
    data = np.frombuffer(b" ".join(t or b"" for t in texts), np.uint8)
    sizes = np.array([len(t or b"") for t in texts])
    first, last = word_bounds(data)
    rolling.load(data)
    codes = _mixed(rolling.of(0, first, last)).view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()
    cuts = np.searchsorted(first, np.cumsum(sizes + 1) - sizes - 1).tolist()
    return [codes[a * CODE : b * CODE] for a, b in zip(cuts, [*cuts[1:], len(first)])]


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of a batch in runs of about ``CHUNK`` bytes."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + CHUNK, "right")))
        yield at, stop
        at = stop


def _sizes(column: pa.Array) -> np.ndarray:
    return np.array([len(x.as_buffer()) if x.is_valid else 0 for x in column], np.int64)


def _anchor_rows(texts: DataFrame, size: int, gram: int, words: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(2)
        for b in batches:
            uid = b.column(0).to_numpy()
            for at, stop in _parts(_sizes(b.column(1))):
                part = b.column(1).slice(at, stop - at).to_pylist()
                if words:
                    part = coded(part, rolling)
                data = np.frombuffer(b"".join(x for x in part if x), np.uint8)
                n = np.array([len(x or b"") for x in part])
                h, c, own, gap, lo, hi = anchors(data, np.cumsum(n) - n, n, rolling, size, gram)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, c, uid[at + own] if len(own) else np.empty(0, np.int64), gap, lo, hi)], ["h", "context", "uid", "gap", "lo", "hi"])

    return texts.select("uid", "text").mapInArrow(run, "h long, context long, uid long, gap int, lo int, hi int")


def shared_starts(contexts: list[bytes], gaps: np.ndarray, grams: np.ndarray, places: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(context, first, last): starts of strings of ``width`` symbols that another place has as well.

    A context is ``gaps`` bytes, its gram as one symbol, and the rest. ``places`` has a number for each context's first
    byte in the corpus, so that overlapping contexts of one text are not taken for copies.
    """
    lengths = np.array([len(c) for c in contexts]) + 1
    begin = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int(lengths.sum()) + len(contexts) + 1, np.int32)
    owner = np.repeat(np.arange(len(contexts)), lengths + 1)
    _, symbol = np.unique(grams, return_inverse=True)
    special = np.zeros(len(text), bool)
    special[begin + lengths] = special[begin + gaps] = special[-1] = True
    text[~special] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int32) + 2
    text[begin + lengths] = 1
    text[begin + gaps] = 258 + symbol
    inside = np.arange(len(owner)) - begin[owner]
    sa = suffix_array(text)
    sa = sa[sa < len(owner)]
    sa = sa[lengths[owner[sa]] - inside[sa] >= width]
    if len(sa) < 2:
        return []
    # neighbours in the order that have the same ``width`` symbols
    joins = np.empty(len(sa) - 1, bool)
    span = np.arange(width)
    for at in range(0, len(joins), 1 << 14):
        x = text[sa[at : at + (1 << 14) + 1][:, None] + span]
        joins[at : at + (1 << 14)] = (x[1:] == x[:-1]).all(1)
    run = np.concatenate([[0], np.cumsum(~joins)])
    first = np.flatnonzero(np.r_[True, ~joins])
    where = places[owner[sa]] + inside[sa]
    many = np.minimum.reduceat(where, first) != np.maximum.reduceat(where, first)
    hit = np.sort(sa[many[run]])
    if not len(hit):
        return []
    cuts = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0))
    head, tail = hit[np.r_[0, cuts + 1]], hit[np.r_[cuts, len(hit) - 1]]
    own = owner[head]
    return list(zip(own.tolist(), (head - begin[own]).tolist(), (tail - begin[own]).tolist()))


def _sorted_shards(contexts: DataFrame, size: int, gram: int) -> DataFrame:
    """h, uid, lo, n, bytes, gap, partitioned and ordered by h, to spans of the contexts that are there once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, last = [], 0, None

        def solve() -> pa.RecordBatch:
            _, text = np.unique([r[1] for r in held], return_inverse=True)
            grams, lo, gaps = (np.array([r[i] for r in held]) for i in (0, 2, 5))
            found = shared_starts([r[4] for r in held], gaps, grams, (text << 32) + lo, size - gram + 1)
            rows = [(held[c][1], held[c][2] + a, held[c][2] + b + size) for c, a, b in found if held[c][3] == 1]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["uid", "lo", "hi"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if total > SHARD and row[0] != last:
                    yield solve()
                    held, total = [], 0
                held.append(row)
                total, last = total + len(row[4]), row[0]
        if held:
            yield solve()

    return contexts.select("h", "uid", "lo", "n", "bytes", "gap").mapInArrow(run, "uid long, lo int, hi int")


def _coded_contexts(texts: DataFrame, kinds: DataFrame, gram: int) -> DataFrame:
    """h, uid, lo, n, bytes, gap of the contexts in the codes of words."""
    wanted = kinds.groupBy("uid").agg(F.collect_list(F.struct("h", "lo", "n", "gap", "hi")).alias("wants"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            for at, stop in _parts(_sizes(b.column(1))):
                wants = b.column(2).slice(at, stop - at)
                h, lo, n, gap, hi = wants.flatten().flatten()
                row = np.repeat(np.arange(stop - at), wants.value_lengths().to_numpy())
                own = coded(b.column(1).slice(at, stop - at).to_pylist(), rolling)
                pieces = [own[i][x : x + g] + own[i][x + g + gram : y] for i, x, g, y in zip(row.tolist(), lo.to_pylist(), gap.to_pylist(), hi.to_pylist())]
                yield pa.RecordBatch.from_arrays([h, b.column(0).take(pa.array(at + row)), lo, n, pa.array(pieces, pa.binary()), gap], ["h", "uid", "lo", "n", "bytes", "gap"])

    return texts.select("uid", "text").join(wanted.hint("shuffle_hash"), "uid").mapInArrow(run, "h long, uid long, lo int, n long, bytes binary, gap int")


def repeated_spans(texts: DataFrame, size: int = SIZE, gram: int = GRAM, words: bool = False) -> DataFrame:
    """Bucketed (uid, text) to (uid, lo, hi): bytes to remove, with ``words`` of their codes; spans of a text may overlap."""
    same = Window.partitionBy("h")
    found = _anchor_rows(texts, size, gram, words).withColumn("n", F.count("*").over(same))
    found = found.withColumn("mixed", F.min("context").over(same) != F.max("context").over(same)).where("n > 1").drop("n")
    hits = written(found, "hits")
    kinds = hits.where("mixed").groupBy("h", "context").agg(F.count("*").alias("n"), F.min(F.struct("uid", "lo", "hi", "gap")).alias("one"))
    kinds = written(kinds.select("h", "context", "n", "one.*"), "kinds")
    whole = hits.where("not mixed").select("uid", "lo", "hi").unionByName(
        hits.where("mixed").join(kinds.where("n > 1").select("h", "context"), ["h", "context"]).select("uid", "lo", "hi")
    )
    total = kinds.agg(F.coalesce(F.sum(F.col("hi") - F.col("lo") - gram), F.lit(0))).first()[0]
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if words:
        contexts = _coded_contexts(texts, kinds, gram)
    else:
        after = F.col("lo") + F.col("gap") + gram
        piece = F.concat(F.substring("text", F.col("lo") + 1, F.col("gap")), F.substring("text", after + 1, F.col("hi") - after))
        contexts = texts.join(kinds.hint("shuffle_hash"), "uid").select("h", "uid", "lo", "n", piece.alias("bytes"), "gap")
    shards = contexts.repartition(max(least, total // SHARD + 1), "h").sortWithinPartitions("h", "uid", "lo")
    return whole.unionByName(_sorted_shards(shards, size, gram))


def keep_unrepeated(docs: DataFrame, size: int = SIZE, gram: int = GRAM, keep: tuple[str, ...] = ("doc_id",), words: bool = False) -> DataFrame:
    """``keep`` columns with kept (the remaining bytes), n_bytes, n_removed and n_spans of every row; with ``words``, sizes are those of words' codes."""
    shared_dir(docs.sparkSession)
    least = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = positional(docs, list(keep))
    texts = bucketed(docs.select(F.monotonically_increasing_id().alias("uid"), F.col("text").cast("binary").alias("text"), *own), "uid", least)
    spans = repeated_spans(texts, size, gram, words).groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    rows = texts.join(spans.hint("shuffle_hash"), "uid", "left")
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, numbers = [], []
            for t, spans in zip(b.column(n_keep), b.column(n_keep + 1)):
                data = (t.as_py() or b"") if t.is_valid else b""
                if not spans.is_valid:
                    out.append(data)
                    numbers.append((len(data), 0, 0))
                    continue
                lo, hi = (spans.values.field(k).to_numpy() for k in range(2))
                if words:
                    first, last = word_bounds(np.frombuffer(data, np.uint8))
                    lo, hi = first[-(-lo // CODE)], last[hi // CODE - 1]
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi, -1)
                gone = np.cumsum(edge[:-1]) > 0
                out.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                numbers.append((len(data), int(gone.sum()), int(np.diff(np.r_[0, gone.astype(np.int8)]).clip(0).sum())))
            cols = [pa.array(out, pa.binary()), *(pa.array([x[i] for x in numbers], pa.int64()) for i in range(3))]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], *cols], [*(f"_k{i}" for i in range(n_keep)), "kept", "n_bytes", "n_removed", "n_spans"])

    schema = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep)) + "kept binary, n_bytes long, n_removed long, n_spans long"
    out = rows.select(*[f"_k{i}" for i in range(n_keep)], "text", "spans").mapInArrow(run, schema)
    made = ["kept", "n_bytes", "n_removed", "n_spans"]
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep) if c not in made], *made)


def texts_without_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``docs`` with the remaining bytes as text, read as UTF-8; a character that is cut goes, a null text stays null.

    No row goes: repeated rows lose what they share, null and equal ids don't matter, an empty table stays empty, and columns of any name are kept.
    """
    return _rewritten(docs, size, gram, False)


def _rewritten(docs: DataFrame, size: int, gram: int, words: bool) -> DataFrame:
    columns = docs.columns
    # the text itself is kept once, as the bytes that are searched
    rest = [c for c in columns if c != "text"]
    names = {c: f"_c{i}" for i, c in enumerate(rest)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("text"), F.col("text").isNull().alias("_none"), F.lit(0).alias("doc_id"))
    kept = keep_unrepeated(rows, size, gram, (*names.values(), "_none"), words)
    left = F.col("kept").cast("string")
    whole = F.replace(F.make_valid_utf8(left), F.lit("\ufffd"), F.lit(""))
    text = F.when(~F.col("_none"), F.when(F.col("n_removed") == 0, left).otherwise(whole))
    return kept.select(*[(text if c == "text" else F.col(names[c])).alias(c) for c in columns])


def texts_without_passages(docs: DataFrame, words: int = PASSAGE) -> DataFrame:
    """``docs`` with the words of every text that no string of ``words`` words covers which also starts anywhere else, same row included.

    White space between removed words goes with them, and doesn't tell strings apart. Rows, ids, nulls and columns are treated as by ``texts_without_repeats``.
    """
    return _rewritten(docs, words * CODE, words * CODE - SLACK, True)


def query(spark, sf_dir: str) -> DataFrame:
    kept = keep_unrepeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
