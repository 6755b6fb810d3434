"""A gated recurrent language model over whole documents, in numpy, with counts and training spread over Spark.

All training tokens are counted in Spark. The ``OWN`` most frequent words have a code of their own; every other word has the code
of its bucket, a hash of its first two bytes, and is told from its like by add-one smoothed counts, so that the model's
probabilities of all words sum to one. A gated recurrent unit reads the codes; its output softmax is factored in classes
of equally many codes by frequency. Truncated backpropagation runs over windows of ``WINDOW`` steps, the state being carried
from window to window. The training documents are dealt by hash to slices, each document to one; in a round, learners in
proportion to the slice's tokens learn from it, and their parameters are averaged in executors. So every document is learned
from, once in a large corpus and up to ``PASSES`` times in a small one. Scoring reads whole documents.

Counts of the ``COMMON`` most frequent words travel to the tasks, the others are joined by word.

Defined cases: a null or empty text has the single token that ends it; without training documents all counts are 0 and
the model is the untrained one; repeated rows and equal or null doc_ids give a row each; an empty table gives an empty
result; further columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import summed, written
from .langid import held_out

CLASSES, PER_CLASS, HIDDEN, BUCKETS = 32, 32, 24, 256
CODES = CLASSES * PER_CLASS
OWN = CODES - BUCKETS
#: Words whose counts travel to the tasks: a bound, not a cut, for the rest is joined.
COMMON = 1 << 16
WINDOW, LANES, RATE, SEED = 32, 256, 5e-3, 5
#: Tokens that a learner and a round are meant for, most rounds of a pass, tokens below which more passes are made, most of them.
LEARN, ROUND, ROUNDS, SMALL, PASSES = 1 << 18, 1 << 21, 32, 1 << 21, 8
#: Steps of Adam that a training is meant for, one after another: fewer tokens are laid in fewer lanes.
UPDATES = 768
END = b"\n"  # no word holds white space


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words, then the end."""
    return [*(text or b"").lower().split(), END]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Gru:
    """Parameters: ``x`` inputs by code, ``u`` recurrent, ``c``/``cb`` classes, ``w``/``wb`` codes within a class.

    ``rank`` is a code's place by frequency: classes are ranges of it, so that most tokens are of few classes.
    """

    def __init__(self, counts: np.ndarray, seed: int = SEED):
        rng, h = np.random.default_rng(seed), HIDDEN
        self.rank = np.empty(CODES, np.int32)
        order = np.argsort(-counts, kind="stable")
        self.rank[order] = np.arange(CODES, dtype=np.int32)
        # a code that no word has gets next to nothing
        each = np.where(counts > 0, counts + 1.0, 1e-4)[order].reshape(CLASSES, PER_CLASS)
        self.p = {
            "x": rng.normal(0, 0.1, (CODES, 3 * h)),
            "u": rng.normal(0, h**-0.5, (h, 3 * h)) * 0.5,
            "c": np.zeros((h, CLASSES)),
            "cb": np.log(each.sum(1) / each.sum()),
            "w": np.zeros((CLASSES, h, PER_CLASS)),
            "wb": np.log(each / each.sum(1, keepdims=True)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def advance(self, state: np.ndarray, codes: np.ndarray, kept: list | None = None) -> np.ndarray:
        h, g = HIDDEN, self.p["x"].take(codes, axis=0)
        hu = state @ self.p["u"]
        g[:, : 2 * h] += hu[:, : 2 * h]
        zr = _sigmoid(g[:, : 2 * h].copy())
        n = np.tanh(g[:, 2 * h :] + zr[:, h:] * hu[:, 2 * h :])
        if kept is not None:
            kept.append((state, zr, n, hu[:, 2 * h :]))
        return n + zr[:, :h] * (state - n)

    def log_probs(self, states: np.ndarray, codes: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of codes from the states before them; with ``grads``, gradients of their negative mean."""
        kind, inner = np.divmod(self.rank.take(codes), PER_CLASS)
        order = np.argsort(kind, kind="stable")
        states, kind, inner = states.take(order, axis=0), kind[order], inner[order]
        z = states @ self.p["c"]
        z += self.p["cb"]
        z -= z.max(1, keepdims=True)
        rows = np.arange(len(codes))
        got = z[rows, kind]
        np.exp(z, out=z)
        total = z.sum(1)
        got -= np.log(total)
        back = None
        if grads is not None:
            z /= total[:, None]
            z[rows, kind] -= 1
            z /= len(codes)
            grads["c"] += states.T @ z
            grads["cb"] += z.sum(0)
            back = z @ self.p["c"].T
        ends = np.searchsorted(kind, np.arange(CLASSES + 1))
        for k in np.flatnonzero(np.diff(ends)):
            at = slice(ends[k], ends[k + 1])
            s, mine = states[at], inner[at]
            z = s @ self.p["w"][k]
            z += self.p["wb"][k]
            z -= z.max(1, keepdims=True)
            rows = np.arange(len(s))
            own = z[rows, mine]
            np.exp(z, out=z)
            total = z.sum(1)
            got[at] += own - np.log(total)
            if grads is not None:
                z /= total[:, None]
                z[rows, mine] -= 1
                z /= len(codes)
                grads["w"][k] += s.T @ z
                grads["wb"][k] += z.sum(0)
                back[at] += z @ self.p["w"][k].T
        out = np.empty_like(got)
        out[order] = got
        if back is not None:
            back[order] = back.copy()
        return out, back

    def gradients(self, codes: np.ndarray, fresh: np.ndarray, live: np.ndarray, state: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Of the negative mean log probability of a window's live codes, from the state carried in, which moves on."""
        h = HIDDEN
        g = {k: np.zeros_like(a) for k, a in self.p.items()}
        kept: list = []
        now = state[0]
        old = ~fresh
        for step in range(len(codes)):
            now = now * old[step][:, None]
            now = self.advance(now, codes[step], kept)
        state[0] = now
        before = np.concatenate([k[0] for k in kept])
        on = np.flatnonzero(live.ravel())
        _, back = self.log_probs(before.take(on, axis=0), codes.ravel()[on], g)
        dh_out = np.zeros_like(before)
        dh_out[on] = back
        dh_out = dh_out.reshape(len(codes), -1, h)
        u_zr, u_n, dh = self.p["u"][:, : 2 * h].T.copy(), self.p["u"][:, 2 * h :].T.copy(), np.zeros_like(now)
        at_x, at_n = np.empty((*codes.shape, 3 * h), np.float32), np.empty((*codes.shape, h), np.float32)
        for step in range(len(codes) - 1, -1, -1):
            prev, zr, n, hn = kept[step]
            z, r = zr[:, :h], zr[:, h:]
            d = at_x[step]
            keep = dh * z
            dn = dh - keep
            dn *= 1 - n * n
            np.multiply(dh * (prev - n), z - z * z, out=d[:, :h])
            np.multiply(dn * hn, r - r * r, out=d[:, h : 2 * h])
            d[:, 2 * h :] = dn
            np.multiply(dn, r, out=at_n[step])
            dh = keep
            dh += d[:, : 2 * h] @ u_zr
            dh += at_n[step] @ u_n
            dh += dh_out[step]
            dh *= old[step][:, None]
        g["u"][:, : 2 * h] += before.T @ at_x[..., : 2 * h].reshape(-1, 2 * h)
        g["u"][:, 2 * h :] += before.T @ at_n.reshape(-1, h)
        flat = codes.ravel()
        order = np.argsort(flat, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
        g["x"][flat[order[cut]]] = np.add.reduceat(at_x.reshape(-1, 3 * h).take(order, axis=0), cut, axis=0)
        return g

    def learn(self, docs: list[np.ndarray], most: int = LANES) -> None:
        """One pass of truncated backpropagation with Adam, over at most ``most`` documents at a time."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v, t = {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        for codes, fresh, live, state in lanes(docs, most):
            g = self.gradients(codes, fresh, live, state)
            t += 1
            for k, a in g.items():
                np.clip(a, -1, 1, out=a)
                m[k] += 0.1 * (a - m[k])
                v[k] += 0.01 * (a * a - v[k])
                self.p[k] -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each document's codes."""
        out = np.zeros(len(docs))
        for codes, fresh, live, state, owner in lanes(docs, LANES, owners=True):
            now = state[0]
            before = np.empty((*codes.shape, HIDDEN), np.float32)
            for step in range(len(codes)):
                if fresh[step].any():
                    now = now * ~fresh[step][:, None]
                before[step] = now
                now = self.advance(now, codes[step])
            state[0] = now
            on = np.flatnonzero(live.ravel())
            got, _ = self.log_probs(before.reshape(-1, HIDDEN)[on], codes.ravel()[on])
            out += np.bincount(owner.ravel()[on], got, len(docs))
        return out


def lanes(docs: list[np.ndarray], most: int, owners: bool = False) -> Iterator[tuple]:
    """Documents laid end to end in evenly filled lanes, cut in windows; ``state`` is a cell that carries the state over."""
    if not docs:
        return
    sizes = [len(d) for d in docs]
    n = int(np.clip(sum(sizes) // max(sizes), 1, most))
    heap, laid = [(0, i) for i in range(n)], [[] for _ in range(n)]
    for i in sorted(range(len(docs)), key=lambda i: -sizes[i]):
        filled, lane = heapq.heappop(heap)
        laid[lane].append(i)
        heapq.heappush(heap, (filled + sizes[i], lane))
    steps = max(filled for filled, _ in heap)
    codes, live, fresh = np.zeros((steps, n), np.int32), np.zeros((steps, n), bool), np.zeros((steps, n), bool)
    owner = np.zeros((steps, n), np.int32)
    for lane, own in enumerate(laid):
        at = 0
        for i in own:
            codes[at : at + sizes[i], lane], owner[at : at + sizes[i], lane] = docs[i], i
            fresh[at, lane] = True
            at += sizes[i]
        live[:at, lane] = True
    state = [np.zeros((n, HIDDEN), np.float32)]
    for at in range(0, steps, WINDOW):
        cut = slice(at, at + WINDOW)
        yield (codes[cut], fresh[cut], live[cut], state, owner[cut]) if owners else (codes[cut], fresh[cut], live[cut], state)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for t in b.column(0):
                seen.update(tokens(t.as_py()))
                if len(seen) > 1 << 19:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "c"])
                    seen = Counter()
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "c"])

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def bucket_of(word: bytes) -> int:
    """The bucket of a word without a code of its own."""
    return zlib.crc32(word[:2]) % BUCKETS


class Vocabulary:
    """Codes and counts of the most frequent words; ``buckets`` has (tokens, words) of each bucket, the ``OWN`` first words left out."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, buckets: dict[int, tuple[int, int]] | None = None):
        self.words = {w: i for i, w in enumerate(words)}
        self.log_count = np.log10(np.array([*counts, 0], np.float64) + 1)  # the last stands for words not in the list
        self.known = np.array([c > 0 for c in counts] + [False])
        own = min(len(words), OWN)
        self.code = np.zeros(len(words) + 1, np.int32)
        self.code[:own] = BUCKETS + np.arange(own)
        self.code[own:-1] = [bucket_of(w) for w in words[own:]]
        self.total, self.distinct = total, distinct
        self.code_counts = np.zeros(CODES)
        self.code_counts[BUCKETS : BUCKETS + own] = counts[:own]
        #: what the add-one counts of a bucket's words sum to, one more for words never seen
        self.log_bucket = np.zeros(CODES)
        for b in range(BUCKETS):
            tokens_of, words_of = (buckets or {}).get(b, (0, 0))
            self.code_counts[b] = tokens_of + 1
            self.log_bucket[b] = np.log10(tokens_of + words_of + 1)

    def ids(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Place in the list and code of each token, and the tokens."""
        words, none = tokens(text), len(self.words)
        ids = np.fromiter(map(self.words.get, words, repeat(none)), np.int32, len(words))
        codes = self.code.take(ids)
        odd = np.flatnonzero(ids == none)
        codes[odd] = [bucket_of(words[i]) for i in odd]
        return ids, codes, words


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """From (word, c): the driver gets at most ``COMMON`` words and one row a bucket."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(COMMON).toArrow()
    words, own = top.column(0).to_pylist(), top.column(1).to_pylist()
    bucket = F.crc32(F.substring("word", 1, 2)) % BUCKETS
    by = {r["b"]: [r["n"], r["v"]] for r in counts.groupBy(bucket.cast("int").alias("b")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    for w, c in zip(words[:OWN], own[:OWN]):
        by[bucket_of(w)][0] -= c
        by[bucket_of(w)][1] -= 1
    return Vocabulary(words, own, sums["n"], sums["v"], {b: (n, v) for b, (n, v) in by.items()})


def plan(tokens_in_training: int) -> tuple[int, int, int, int]:
    """Passes over the corpus, rounds of a pass, learners of a round, and lanes of a learner, for so many tokens."""
    passes = int(np.clip(-(-SMALL // max(1, tokens_in_training)), 1, PASSES))
    rounds = int(np.clip(-(-tokens_in_training // ROUND), 1, ROUNDS))
    learners = max(1, round(tokens_in_training / rounds / LEARN))
    return passes, rounds, learners, int(np.clip(tokens_in_training * passes // (learners * WINDOW * UPDATES), 8, LANES))


def coded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every document read once: its codes (two bytes a token), what its counts are, and its words that aren't listed; written by slice."""
    rounds = plan(vocabulary.total)[1]
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("slice", pa.int32()), ("h", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("rare_base", pa.float64()), ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())), ("codes", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, vocabulary = TaskContext.get().partitionId() << 36, sent.value
        unlisted = len(vocabulary.words)
        for b in batches:
            out = []
            for doc_id, held, part, h, t in zip(*(b.column(i).to_pylist() for i in range(4)), b.column(4)):
                ids, own, words = vocabulary.ids(t.as_py())
                logs, rare = vocabulary.log_count[ids], own < BUCKETS
                odd = Counter(words[i] for i in np.flatnonzero(ids == unlisted))
                rest = float(logs[rare].sum() - vocabulary.log_bucket[own[rare]].sum())
                out.append((row, doc_id, held, part, h, len(ids), int(vocabulary.known[ids].sum()), float(logs.sum()), rest, list(odd), list(odd.values()), own.astype(np.uint16).tobytes()))
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", F.length("text")), F.lit(rounds)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long"), "held_out", draw.alias("slice"), F.xxhash64(F.lit(SEED + 1), "doc_id").alias("h"), F.col("text").cast("binary").alias("text"))
    schema = "row long, doc_id long, held_out boolean, slice int, h long, n_tokens long, known long, base double, rare_base double, words array<binary>, times array<int>, codes binary"
    # written by slice, so that a round reads its own documents only
    return written(rows.mapInArrow(run, schema), "coded", by="slice")


def trained(rows: DataFrame, vocabulary: Vocabulary) -> Gru:
    """Rounds of parallel learning from ``coded`` rows that aren't held out, averaged in executors; one set of parameters comes to the driver a round."""
    model = Gru(vocabulary.code_counts)
    names = list(model.p)
    if not vocabulary.total:
        return model
    passes, rounds, learners, most = plan(vocabulary.total)
    for r in range(rounds * passes):

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            size, held, waiting = 0, [], 0
            for b in batches:
                for t in b.column(0):
                    held.append(np.frombuffer(t.as_buffer(), np.uint16).astype(np.int32))
                    waiting, size = waiting + len(held[-1]), size + len(held[-1])
                    if waiting > 1 << 20:
                        model.learn(held, most)
                        held, waiting = [], 0
            if held:
                model.learn(held, most)
            if size:
                parts = [*((model.p[k] * np.float32(size)).tobytes() for k in names), np.array([size], np.float32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts))), pa.array(parts, pa.binary())], ["at", "y"])

        # dealt out evenly, not by key
        own = rows.where((F.col("slice") == r % rounds) & ~F.col("held_out")).select("h", "codes")
        dealt = own.repartition(learners).sortWithinPartitions("h", "codes").select("codes")
        got = dict(summed(dealt.mapInArrow(run, "at long, y binary"), len(names) + 1, learners))
        if got:
            for i, k in enumerate(names):
                model.p[k] = (got[i] / got[len(names)]).reshape(model.p[k].shape)
    return model


def score(rows: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: Gru) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score of every ``coded`` document."""
    chunk = 1 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.array([len(c.as_buffer()) // 2 for c in b.column(7)])
            at = 0
            while at < b.num_rows:
                stop = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), chunk, "right")))
                part = b.slice(at, stop - at)
                ln = model.scores([np.frombuffer(c.as_buffer(), np.uint16).astype(np.int32) for c in part.column(7)]) / np.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns[:7], pa.array(ln)], [*names, "score"])
                at = stop

    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "rare_base"]
    scored = rows.select(*names, "codes").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, rare_base double, score double")
    odd = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("o")).select("row", F.col("o.words").alias("word"), F.col("o.times").alias("times"))
    rest = odd.join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("times").alias("known_more"))
    all_rows = scored.join(rest, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    whole = float(np.log10(vocabulary.total + vocabulary.distinct + 1))
    return all_rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("score") + F.col("rare_base") + more).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held_out(7, 2).alias("held_out"))
    learning = docs.where("not held_out")
    counts = written(count_words(learning), "counts")
    vocabulary = vocabulary_of(counts)
    rows = coded(docs, vocabulary)
    return score(rows, counts, vocabulary, trained(rows, vocabulary))
