"""Language identification by a byte convolutional network, trained and applied in numpy.

The network embeds bytes, runs filters of several widths over a window, takes each filter's maximum and ends in a
softmax. It is fitted, in one task, on a bounded sample: about ``DOCS_PER_LANG`` labelled texts a language, fewer where languages are
so many that this would pass ``DOCS`` in all, chosen by a hash of the id, and ``WINDOWS_PER_DOC`` windows of each. Every text is then cut into windows of ``WINDOW`` bytes from its first to
its last byte; a text's probabilities are those of its windows, weighed by their bytes.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned; rows
without a text or a language aren't learned from; a short window is padded with byte 0; repeated rows give a row each; an
empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import positional, written

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 8, 8
#: Bounds of the sample that is learned from: texts of a language, texts in all (one a language at least), windows of a text.
DOCS_PER_LANG, DOCS, WINDOWS_PER_DOC = 1000, 40_000, 4
EPOCHS, BATCH, RATE, SEED = 8, 128, 5e-3, 11
UNKNOWN = "und"


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a whole text as rows of bytes, and how many bytes of each are text."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    size = np.full(n, WINDOW)
    size[-1] = len(text) - (n - 1) * WINDOW
    return out.reshape(n, WINDOW), size


class ByteConvNet:
    """Embedding, convolutions, maximum over time, softmax."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "out": rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(langs))), "bias": np.zeros(len(langs))}
        for w in WIDTHS:
            self.p |= {f"w{w}": rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)), f"b{w}": np.zeros(FILTERS)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy; only the place of a filter's maximum gets one."""
        p, g, n = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}, len(x)
        e = p["emb"][x]
        tops, pooled = {}, []
        for w in WIDTHS:
            cols = np.concatenate([e[:, i : WINDOW - w + 1 + i] for i in range(w)], axis=2)
            r = cols @ p[f"w{w}"] + p[f"b{w}"]
            tops[w] = r.argmax(1)
            pooled.append(np.maximum(np.take_along_axis(r, tops[w][:, None], 1)[:, 0], 0))
        h = np.concatenate(pooled, 1)
        z = h @ p["out"] + p["bias"]
        z -= z.max(1, keepdims=True)
        q = np.exp(z)
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        g["out"], g["bias"] = h.T @ q, q.sum(0)
        dh = (q @ p["out"].T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            d = dh[:, k * FILTERS : (k + 1) * FILTERS]
            at = x[np.arange(n)[:, None, None], tops[w][:, :, None] + np.arange(w)]
            patch = p["emb"][at].reshape(n, FILTERS, w * EMBED)
            g[f"w{w}"] = np.einsum("nf,nfk->kf", d, patch)
            g[f"b{w}"] = d.sum(0)
            np.add.at(g["emb"], at, (d[:, :, None] * p[f"w{w}"].T[None]).reshape(n, FILTERS, w, EMBED))
        return g

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        t = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                t += 1
                for k, g in self.step(x[order[at : at + BATCH]], y[order[at : at + BATCH]]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def tables(self) -> None:
        """Each filter's response is a sum over its bytes, so pairs of bytes are looked up at once."""
        self.pairs, self.ones = {}, {}
        for w in WIDTHS:
            kernel = self.p[f"w{w}"].reshape(w, EMBED, FILTERS)
            one = [self.p["emb"] @ kernel[i] for i in range(w)]
            self.pairs[w] = [(one[i][:, None] + one[i + 1][None]).reshape(1 << 16, FILTERS) for i in range(0, w - 1, 2)]
            self.ones[w] = one[w - 1] if w % 2 else None

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each window, over ``langs``."""
        pair = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        pooled = []
        for w in WIDTHS:
            n = WINDOW - w + 1
            r = self.pairs[w][0].take(pair[:, :n], axis=0)
            for i, more in enumerate(self.pairs[w][1:], 1):
                r += more.take(pair[:, 2 * i : 2 * i + n], axis=0)
            if self.ones[w] is not None:
                r += self.ones[w].take(x[:, w - 1 : w - 1 + n], axis=0)
            pooled.append(np.maximum(r.max(1) + self.p[f"b{w}"], 0))
        z = np.concatenate(pooled, 1) @ self.p["out"] + self.p["bias"]
        z -= z.max(1, keepdims=True)
        q = np.exp(z)
        return q / q.sum(1, keepdims=True)


def training_windows(docs: DataFrame) -> DataFrame:
    """(draw, lang, bytes) of the bounded sample: ``draw`` is a hash of id and text, so its order depends on these only.

    Rows of equal or null id are drawn by their texts; rows that are equal in both are taken or left together, as far as the bound goes.
    """
    usable = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "doc_id", F.col("text").cast("binary").alias("text"))
    counts = written(usable.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    scale, of_lang = 1 << 30, max(1, min(DOCS_PER_LANG, DOCS // max(1, counts.count())))
    # some more than are wanted, so that no language is left without a text; the least draws of them are taken
    most = counts.select(F.col("lang").alias("_lang"), (F.lit(scale * (of_lang + 8 * of_lang**0.5)) / F.col("n")).alias("most"))
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(scale))
    chosen = usable.withColumn("draw", draw).join(most, F.col("lang") == F.col("_lang")).where("draw <= most")
    chosen = chosen.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).where(F.col("nth") <= of_lang)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, draws, out = [], [], []
            for name, d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                rows, _ = windows(t)
                for i in np.unique(np.linspace(0, len(rows) - 1, WINDOWS_PER_DOC).astype(int)):
                    lang.append(name), draws.append(d), out.append(rows[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(draws, pa.int64()), pa.array(lang), pa.array(out, pa.binary())], ["draw", "lang", "bytes"])

    return chosen.select("lang", "draw", "text").mapInArrow(cut, "draw long, lang string, bytes binary")


def train(docs: DataFrame) -> ByteConvNet | None:
    """The network, fitted in one task on the bounded sample; only its parameters come to the driver."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        if not rows:
            return
        langs = sorted({r[1] for r in rows})
        net, place = ByteConvNet(langs), {name: i for i, name in enumerate(langs)}
        net.fit(np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW), np.array([place[r[1]] for r in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([langs], pa.list_(pa.string())), pa.array([list(net.p)], pa.list_(pa.string())), pa.array([[v.tobytes() for v in net.p.values()]], pa.list_(pa.binary()))], ["langs", "names", "values"])

    got = training_windows(docs).coalesce(1).mapInArrow(fit, "langs array<string>, names array<string>, values array<binary>").collect()
    if not got:
        return None
    net = ByteConvNet(list(got[0]["langs"]))
    net.p = {k: np.frombuffer(bytes(v), np.float32).reshape(net.p[k].shape) for k, v in zip(got[0]["names"], got[0]["values"])}
    return net


def predict(docs: DataFrame, net: ByteConvNet | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id) with lang_pred and score."""
    keep = keep or ["doc_id"]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    chunk = 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net.tables()
        for b in batches:
            n = b.num_rows
            total = np.zeros((n, len(net.langs)))
            held: list = []
            count = 0

            def flush() -> None:
                nonlocal count
                rows = np.concatenate([h[1] for h in held])
                weight = np.concatenate([h[2] for h in held])
                owner = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
                for at in range(0, len(rows), chunk):
                    cut = slice(at, at + chunk)
                    np.add.at(total, owner[cut], net.probabilities(rows[cut]) * weight[cut, None])
                held.clear()
                count = 0

            for i, t in enumerate(b.column(n_keep)):
                if t.is_valid:
                    held.append((i, *windows(t.as_py())))
                    count += len(held[-1][1])
                    if count >= chunk:
                        flush()
            if held:
                flush()
            known = total.sum(1) > 0
            total /= np.maximum(total.sum(1, keepdims=True), 1e-12)
            best = total.argmax(1)
            lang = pa.array([net.langs[j] if k else UNKNOWN for j, k in zip(best, known)], pa.string())
            score = np.where(known, np.clip(total[np.arange(n), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], lang, pa.array(score)], [*names, "lang_pred", "score"])

    n_keep = len(keep)
    names = [f"_k{i}" for i in range(n_keep)]
    rows = docs.select(*positional(docs, keep), F.when(letters, F.col("text").cast("binary")).alias("_text"))
    schema = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep)) + "lang_pred string, score double"
    made = [c for c in keep if c not in ("lang_pred", "score")]
    return rows.mapInArrow(run, schema).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep) if c in made], "lang_pred", "score")


#: Documents whose language is less sure than this are rejected, as are those without one.
LEAST_SCORE = 0.3


def accepted(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language is unknown or too unsure; learns from the labelled ones of them.

    Rows are judged by their texts alone: repeated rows, null and equal ids stay or go alike, null texts and texts without a letter go, and
    an empty table, or one without a label to learn from, gives an empty one. Columns of any name are kept.
    """
    columns = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)], "text")
    told = predict(inner, train(docs), [f"_c{i}" for i in range(len(columns))])
    sure = told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return sure.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])


def held_out(modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    net = train(docs.where(~held_out(4, 2)))
    return predict(docs, net).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
