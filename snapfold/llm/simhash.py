"""SimHash near-duplicates, linked through BK-trees.

A document's fingerprint has bit i set if more than half of its shingles' XXH64 hashes have. Equal fingerprints are one
node. Nodes within the radius agree on at least one of radius + 1 bands of bits, so each node goes to one shard a band;
a shard above ``SHARD`` nodes is cut again by bands of the bits that are still free, until at most ``FREE`` stay, so that a
shard has no more nodes than these bits have values (at radius 2 after three cuts). Each shard gets
a BK-tree, whose children are keyed by their Hamming distance to the parent; searches descend only edges within the
radius of the distance at hand, many at a time in numpy. The trees travel to the tasks with the shuffle, not through
the driver: a broadcast variable would gather all fingerprints there. From a shard come only links that join its
sets, fewer than it has nodes, so that a group of near copies never becomes all its pairs.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other; fewer words
than a shingle: one shingle of all words; repeated rows and equal doc_ids give a row each; a null doc_id is linked but
never names its component unless it is alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, written
from .components import components

SEED = 42
#: Nodes of a shard beyond which it is cut again.
SHARD = 2048
#: Free bits at which a shard isn't cut any more, and cuts after which none is, since each multiplies the rows by the bands.
FREE, CUTS = 20, 3
#: Rows of a partition of shards, and rows of whole shards that a task holds at once: a longer shard is held alone.
ROWS, HELD = 1 << 20, 1 << 18
#: Searches that descend together.
BATCH = 1 << 16


def shingles_hashes(text: bytes | None, k: int) -> np.ndarray:
    """XXH64 of the k-word shingles of a text, its ASCII letters lowered."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([h(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - k])).tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    return np.array([h(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The SimHash as a signed 64-bit integer."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, fp (signed), n_shingles of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [shingles_hashes(t.as_py(), k) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(h) for h in each], pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


class Forest:
    """BK-trees over the nodes of many shards at once; ``fps`` are distinct within a shard, ``shard`` is sorted."""

    def __init__(self, fps: np.ndarray, shard: np.ndarray):
        n = len(fps)
        self.fps = fps
        first = np.r_[True, shard[1:] != shard[:-1]]
        self.root = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        waiting = np.flatnonzero(~first)
        at = self.root[waiting]
        while len(waiting):
            d = np.bitwise_count(fps[waiting] ^ fps[at]).astype(np.int64)
            _, new, where = np.unique(at * 65 + d, return_index=True, return_inverse=True)
            parent[waiting[new]], edge[waiting[new]] = at[new], d[new]
            down = np.ones(len(waiting), bool)
            down[new] = False
            waiting, at = waiting[down], waiting[new][where][down]
        key = parent * 65 + edge
        key[parent < 0] = -1
        self.child = np.argsort(key, kind="stable")
        self.keys = key[self.child]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of nodes within the radius, in batches."""
        n = len(self.fps)
        for start in range(0, n, BATCH):
            stack = [(np.arange(start, min(n, start + BATCH)), self.root[start : start + BATCH])]
            while stack:
                q, at = stack.pop()
                if len(q) > BATCH:
                    stack += [(q[i : i + BATCH], at[i : i + BATCH]) for i in range(0, len(q), BATCH)]
                    continue
                d = np.bitwise_count(self.fps[q] ^ self.fps[at]).astype(np.int64)
                hit = (d <= radius) & (q > at)
                if hit.any():
                    yield q[hit], at[hit]
                lo = np.searchsorted(self.keys, at * 65 + np.maximum(d - radius, 1))
                hi = np.searchsorted(self.keys, at * 65 + np.minimum(d + radius, 64), "right")
                many = hi - lo
                if total := int(many.sum()):
                    place = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
                    stack.append((np.repeat(q, many), self.child[place]))


def joined(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest node of each node's set."""
    up = np.arange(n)
    for a, b in pairs:
        while True:
            while (up[up] != up).any():
                up = up[up]
            ra, rb = up[a], up[b]
            if (apart := ra != rb).sum() == 0:
                break
            np.minimum.at(up, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
    while (up[up] != up).any():
        up = up[up]
    return up


def _bands(bits: list[int], n: int) -> list[list[int]]:
    return [b.tolist() for b in np.array_split(np.array(bits), n)]


def _cut(nodes: DataFrame, radius: int, depth: int) -> DataFrame:
    """shard, free, fp, rep to a row for each band of the free bits; ``free`` is the mask of bits not yet fixed."""
    rows = []
    for path in _paths(radius, depth):
        mask = sum(1 << b for b in path[-1])
        free = sum(1 << b for b in path[-2])
        rows.append((free, mask))
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    cases = [F.when(F.col("free") == signed(f), F.array(*[F.lit(signed(m)).cast("long") for g, m in dict.fromkeys(rows) if g == f])) for f in dict.fromkeys(f for f, _ in rows)]
    band = nodes.withColumn("band", F.explode(F.coalesce(*cases)))
    value = F.col("fp").bitwiseAND(F.col("band"))
    return band.select(F.xxhash64("shard", "band", value).alias("shard"), F.col("free").bitwiseXOR(F.col("band")).alias("free"), "fp", "rep")


def _paths(radius: int, depth: int) -> list[list[list[int]]]:
    """For each way to cut ``depth`` times: the free bits before each cut, then the band taken last."""
    out = [[list(range(64))]]
    for level in range(depth):
        cut = []
        for path in out:
            free = path[-1] if level == 0 else [b for b in path[-2] if b not in path[-1]]
            cut += [[*path[: level], free, band] for band in _bands(free, radius + 1)]
        out = cut
    return out


def node_links(nodes: DataFrame, radius: int) -> DataFrame:
    """(fp, rep), fps distinct, to edges (a, b) of reps that join every set of nodes linked within the radius."""
    spark = nodes.sparkSession
    now = nodes.select(F.lit(0).cast("long").alias("shard"), F.lit(-1).cast("long").alias("free"), "fp", "rep")
    ready = []
    depth = 1
    while True:
        now = _cut(now, radius, depth)
        sizes = now.groupBy("shard").agg(F.count("*").alias("n"))
        now = written(now.join(sizes.where("n > 1"), "shard"), "shards")
        last = depth == CUTS or max(len(path[-2]) - len(path[-1]) for path in _paths(radius, depth)) <= FREE
        ready.append(now if last else now.where(F.col("n") <= SHARD))
        now = now.where(F.col("n") > SHARD).drop("n")
        if last or now.isEmpty():
            break
        depth += 1
    members = ready[0]
    for more in ready[1:]:
        members = members.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, fps, rep in _whole_shards(batches):
            new = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (fps[1:] != fps[:-1])])
            shard, fps, rep = shard[new], fps[new].view(np.uint64), rep[new]
            least = joined(len(fps), Forest(fps, shard).links(radius))
            moved = np.flatnonzero(least != np.arange(len(fps)))
            yield pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[least[moved]])], ["a", "b"])

    # partitions in proportion to the rows, whatever the session's setting
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2, -(-members.count() // ROWS))
    return members.select("shard", "fp", "rep").repartition(parts, "shard").sortWithinPartitions("shard", "fp").mapInArrow(run, "a long, b long")


def _whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of batches sorted by their first column, the columns of some whole shards at a time: about ``HELD`` rows, or one longer shard."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        cols = tuple(b.column(i).to_numpy() for i in range(b.num_columns))
        shard = cols[0]
        # what ends with this batch's last shard but one is whole
        cut = int(np.searchsorted(shard == shard[-1], True))
        if held and rows + cut >= HELD and (cut or held[-1][0][-1] != shard[-1]):
            held.append(tuple(c[:cut] for c in cols))
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, rows, cols = [], 0, tuple(c[cut:] for c in cols)
        held.append(cols)
        rows += len(cols[0])
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def simhash_components(docs: DataFrame, k: int, radius: int) -> DataFrame:
    """doc_id, fp, component_id of every row."""
    prints = written(fingerprints(docs, k), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = components(node_links(nodes.where("rep is not null"), radius))
    named = nodes.join(found, nodes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left")


#: Of ``near_copies``: orders of the shingles, how many that are least in an order make up a part's fingerprint, and texts of a set that are compared together.
ORDERS, PART, TOGETHER = 16, 3, 8192
_ORDERS = np.random.default_rng(9).integers(1, 1 << 63, ORDERS, np.uint64) * np.uint64(2) + np.uint64(1)


def part_fingerprints(hashes: np.ndarray) -> list[int]:
    """SimHashes of the shingles that are least in each order: near copies share most of these, however far the whole's are."""
    each = np.unique(hashes)
    out = []
    for k in range(ORDERS):
        mixed = each * _ORDERS[k]
        mixed ^= mixed >> np.uint64(32)
        least = np.argpartition(mixed, PART - 1)[:PART] if len(each) > PART else slice(None)
        out.append(fingerprint(np.sort(each[least])))
    return out


def similar(sets: list[np.ndarray], groups: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places of similar sets that join all groups that have any; a set's elements are distinct."""
    groups, sizes = groups.copy(), np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(ids, kind="stable")]
    begin = np.searchsorted(np.sort(ids), np.arange(ids.max(initial=-1) + 2))
    mine = np.split(ids, np.cumsum(sizes)[:-1])
    one, two = [], []
    for i in range(len(sets)):
        if (groups == groups[i]).all():
            break
        shared = np.zeros(len(sets), np.int64)
        if len(mine[i]):
            shared += np.bincount(np.concatenate([owner[begin[e] : begin[e + 1]] for e in mine[i]]), minlength=len(sets))
        for j in np.flatnonzero((groups != groups[i]) & (shared >= similarity * (sizes[i] + sizes - shared))):
            if groups[j] != groups[i]:
                one.append(i)
                two.append(int(j))
                groups[groups == groups[j]] = groups[i]
    return np.array(one, np.int64), np.array(two, np.int64)


def near_copies(docs: DataFrame, k: int = 5, similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """``docs`` with one row, the first by doc_id, of each group of texts linked by Jaccard similarity of their shingles.

    Equal texts are one. Of the others, those whose SimHashes a BK-tree links, and those that share the fingerprint of
    a part, are candidates with one that stands for the set; every candidate's similarity is then computed from the texts.
    In sets that this leaves in several groups, every two texts of different groups are compared, in blocks of bounded size.

    Null ids come last in a group, ties go to the row that is read first, a null text is an empty one, and empty texts are equal.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = docs.columns
    own = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)]
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"), *own)
    rows = bucketed(rows, "uid", parts)
    sums = written(rows.select("uid", "doc", F.sha2("body", 256).alias("sum")), "sums")
    first = sums.groupBy("sum").agg(F.min(F.struct(F.coalesce("doc", F.lit((1 << 63) - 1)).alias("doc"), "uid")).alias("f"))
    heads = first.select(F.col("f.uid").alias("uid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole, some = [], []
            for t in b.column(1):
                h = shingles_hashes(t.as_py(), k)
                whole.append(fingerprint(h))
                some.append(part_fingerprints(h))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(whole, pa.int64()), pa.array(some, pa.list_(pa.int64()))], ["uid", "fp", "parts"])

    prints = written(rows.select("uid", "body").mapInArrow(run, "uid long, fp long, parts array<long>").join(heads, "uid", "left_semi"), "prints")
    nodes = prints.groupBy("fp").agg(F.min("uid").alias("rep"))
    alike = prints.join(nodes, "fp").where("uid <> rep").select(F.col("uid").alias("a"), F.col("rep").alias("b"))
    part = prints.select("uid", F.posexplode("parts").alias("order", "part"))
    stands = part.groupBy("order", "part").agg(F.min("uid").alias("b"), F.count("*").alias("n")).where("n > 1")
    shared = part.join(stands, ["order", "part"]).where("uid <> b").select(F.col("uid").alias("a"), "b")
    near = written(node_links(nodes, radius), "near")
    pairs = alike.unionByName(near).unionByName(shared).where("a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    bodies = rows.select("uid", "body")
    both = pairs.join(bodies.withColumnsRenamed({"uid": "a", "body": "one"}), "a").join(bodies.withColumnsRenamed({"uid": "b", "body": "two"}), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = (np.unique(shingles_hashes(t.as_py(), k)) for t in (x, y))
                shared = len(np.intersect1d(p, q, assume_unique=True))
                good.append(shared >= similarity * (len(p) + len(q) - shared))
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep))], ["a", "b"])

    links = written(both.select("a", "b", "one", "two").mapInArrow(verify, "a long, b long"), "links")
    found = components(links)
    # the sets that candidates come from: equal parts, equal SimHashes, and linked SimHashes with all their texts
    linked = near.unionByName(near.select(F.col("b").alias("a"), "b")).distinct().join(nodes, F.col("a") == F.col("rep")).select("fp", "b")
    members = part.select("uid", F.xxhash64(F.lit("part"), "order", "part").alias("bucket"))
    members = members.unionByName(prints.select("uid", F.xxhash64(F.lit("whole"), "fp").alias("bucket")))
    members = members.unionByName(prints.join(linked, "fp").select("uid", F.xxhash64(F.lit("linked"), "b").alias("bucket")))
    grouped = members.join(found, F.col("uid") == F.col("node"), "left").select("uid", "bucket", F.coalesce("component", "uid").alias("group"))
    # two of a set have been compared already; of sets with the same texts one is enough
    apart = grouped.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("uid")).alias("x"), F.sum(F.shiftright(F.xxhash64("uid"), 24)).alias("y"), (F.min("group") != F.max("group")).alias("open"))
    apart = apart.where("open and n > 2").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / TOGETHER).cast("int").alias("blocks"))
    again = written(grouped.join(apart, "bucket"), "again")
    # a large set is dealt to blocks, and every two blocks meet in one task
    block = F.pmod(F.xxhash64("uid"), "blocks").cast("int")
    again = again.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    again = again.withColumn("bucket", F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"))))
    again = again.join(bodies, "uid").select("bucket", "uid", "group", "body")
    again = again.repartition(4 * parts, "bucket").sortWithinPartitions("bucket", "uid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve() -> pa.RecordBatch:
            a, b = similar(sets, np.array(groups), similarity)
            u = np.array(uids)
            return pa.RecordBatch.from_arrays([pa.array(u[a]), pa.array(u[b])], ["a", "b"])

        now, uids, groups, sets = None, [], [], []
        for b in batches:
            for bucket, uid, group, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if bucket != now and uids:
                    yield solve()
                    uids, groups, sets = [], [], []
                now = bucket
                uids.append(uid)
                groups.append(group)
                sets.append(np.unique(shingles_hashes(text, k)))
        if uids:
            yield solve()

    found = components(links.unionByName(again.mapInArrow(compare, "a long, b long")))
    sets = sums.join(first.select("sum", F.col("f.uid").alias("head")), "sum").join(found, F.col("head") == F.col("node"), "left")
    sets = written(sets.select("uid", "doc", F.coalesce("component", "head").alias("set")), "sets")
    kept = sets.groupBy("set").agg(F.min(F.struct(F.coalesce("doc", F.lit((1 << 63) - 1)).alias("doc"), "uid")).alias("f")).select(F.col("f.uid").alias("uid"))
    return rows.join(kept, "uid", "left_semi").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])


#: Production parameters of the registered query.
WORDS, RADIUS = 3, 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_components(docs, WORDS, RADIUS).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
