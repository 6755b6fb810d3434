"""Chroma fingerprints of audio columns, and their alignment.

A recording's frames are turned to energies of the twelve pitch classes, smoothed over time and normalised. Sixteen filters,
sums over rectangles of that image taken from its integral image, are quantised to two Gray-coded bits each: a packed
32-bit integer for each place of a sixteen-frame image. A recording that is searched has such integers from ``phases`` starts within
a hop, so that a copy that begins between two frames is met as well. A recording too short for ``overlap`` integers is looped until
it has them.

Query recordings are searched in blocks of bounded size that travel to the tasks, one block at a time. Equal integers vote in a
histogram of offsets for each query; a recording is linked with a query if at an offset with ``votes`` equal integers or more, over an
overlap of ``overlap`` integers or more, the share of differing bits is at most ``error``. All such offsets are tried, the most voted first.

Recordings with equal fingerprints are one class, and those without integers are one where their payloads are equal; a class is
searched once.

The registered query has no audio table: it reads a document's UTF-8 bytes as 8-bit PCM, one byte a sample, so that its work
and its copies are those of the whole texts. Frames and hop are set for recordings of that length.

Defined cases: a null payload is an empty one; an empty recording has no integers and no links; a WAV payload that is not PCM
raises; equal or null ids give a row each, and a class has its smallest id, or none, as name; an empty table gives an empty
result; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

# Smoothing over frames, and the filters as (kind, lowest pitch class, pitch classes, frames, thresholds).
SMOOTH = np.array([0.25, 0.75, 1.0, 0.75, 0.25], np.float32)
FILTERS = [
    (0, 4, 3, 15, (1.98215, 2.35817, 2.63523)),
    (4, 4, 6, 15, (-1.03809, -0.651211, -0.282167)),
    (1, 0, 4, 16, (-0.298702, 0.119262, 0.558497)),
    (3, 8, 2, 12, (-0.105439, 0.0153946, 0.135898)),
    (3, 4, 4, 8, (-0.142891, 0.0258736, 0.200632)),
    (4, 0, 3, 5, (-0.826319, -0.590612, -0.368214)),
    (1, 2, 2, 9, (-0.557409, -0.233035, 0.0534525)),
    (2, 7, 3, 4, (-0.0646826, 0.00620476, 0.0784847)),
    (2, 6, 2, 16, (-0.192387, -0.029699, 0.215855)),
    (2, 1, 3, 2, (-0.0397818, -0.00568076, 0.0292026)),
    (5, 10, 1, 15, (-0.53823, -0.369934, -0.190235)),
    (3, 6, 2, 10, (-0.124877, 0.0296483, 0.139239)),
    (2, 1, 1, 14, (-0.101475, 0.0225617, 0.231971)),
    (3, 5, 6, 4, (-0.0799915, -0.00729616, 0.063262)),
    (1, 9, 2, 12, (-0.272556, 0.019424, 0.302559)),
    (3, 4, 2, 14, (-0.164292, -0.0321188, 0.0846339)),
]
IMAGE = 16
#: Samples laid end to end, and integers of a block of queries.
CHUNK, BLOCK = 1 << 18, 1 << 21


@dataclass(frozen=True)
class Params:
    """Of the frames and of the search: starts within a hop, equal integers that an offset needs, the shortest overlap, and the largest share of differing bits."""

    rate: int = 11025
    frame: int = 4096
    hop: int = 1365
    lowest: float = 28.0
    highest: float = 3520.0
    phases: int = 1
    votes: int = 2
    overlap: int = 8
    error: float = 0.15


def samples(payload: bytes | None, kind: str) -> np.ndarray:
    """Mono samples in -1 to 1 of ``u8`` or ``s16le`` PCM, or of a ``wav`` file with either."""
    data, channels = payload or b"", 1
    if kind == "wav":
        at, width = 12, 16
        if data[:4] != b"RIFF":
            return np.empty(0, np.float32)
        while at + 8 <= len(data):
            tag, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            body = data[at + 8 : at + 8 + size]
            if tag == b"fmt ":
                if int.from_bytes(body[:2], "little") != 1:
                    raise ValueError("only PCM is read")
                channels, width = int.from_bytes(body[2:4], "little"), int.from_bytes(body[14:16], "little")
            elif tag == b"data":
                data = body
                break
            at += 8 + size + size % 2
        kind = "u8" if width == 8 else "s16le"
    if kind == "u8":
        x = (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128
    else:
        x = np.frombuffer(data[: len(data) // 2 * 2], "<i2").astype(np.float32) / 32768
    return x[: len(x) // channels * channels].reshape(-1, channels).mean(1) if channels > 1 else x


class Chroma:
    def __init__(self, params: Params):
        self.p = params
        freq = np.fft.rfftfreq(params.frame, 1 / params.rate)
        used = (freq >= params.lowest) & (freq <= params.highest)
        pitch = np.round(12 * np.log2(np.maximum(freq, 1e-9) / 440)).astype(int) % 12
        self.to_pitch = (used[:, None] & (pitch[:, None] == np.arange(12))).astype(np.float32)
        self.window = np.hanning(params.frame).astype(np.float32)

    def integers(self, recordings: list[np.ndarray]) -> list[list[np.ndarray]]:
        """Packed integers (uint32) of each recording from each start; the recordings are laid end to end and worked on together."""
        p = self.p
        sizes = np.repeat([len(x) for x in recordings], p.phases)
        shift = np.tile(np.arange(p.phases) * p.hop // p.phases, len(recordings))
        begin = np.repeat(np.cumsum([0, *(len(x) for x in recordings[:-1])]), p.phases) + shift
        frames = np.maximum((sizes - shift - p.frame) // p.hop + 1, 0)
        frames[frames < len(SMOOTH) + IMAGE - 1] = 0
        empty = [[np.empty(0, np.uint32)] * p.phases for _ in recordings]
        if not frames.sum():
            return empty
        x = np.lib.stride_tricks.sliding_window_view(np.concatenate(recordings), p.frame)
        at = np.repeat(begin, frames) + p.hop * (np.arange(frames.sum()) - np.repeat(np.cumsum(frames) - frames, frames))
        energy = np.empty((len(at), 12), np.float32)
        per = max(1, 4 * CHUNK // p.frame)
        for i in range(0, len(at), per):
            spectrum = np.fft.rfft(x[at[i : i + per]] * self.window, axis=1)
            energy[i : i + per] = (spectrum.real**2 + spectrum.imag**2) @ self.to_pitch
        # smoothed over frames: the last ones of a recording reach into the next and go
        m = len(energy) - len(SMOOTH) + 1
        smooth = sum(w * energy[i : i + m] for i, w in enumerate(SMOOTH))
        norm = np.sqrt((smooth**2).sum(1, keepdims=True))
        image = np.where(norm > 0.01, smooth / np.maximum(norm, 1e-9), 0)
        total = np.zeros((m + 1, 13))
        total[1:, 1:] = image.cumsum(0, dtype=np.float64).cumsum(1)
        packed = self.filtered(total, m - IMAGE + 1)
        first = np.cumsum(frames) - frames
        each = [packed[f : f + n - len(SMOOTH) - IMAGE + 2] if n else packed[:0] for f, n in zip(first.tolist(), frames.tolist())]
        return [each[i : i + p.phases] for i in range(0, len(each), p.phases)]

    def looped(self, x: np.ndarray) -> np.ndarray:
        """A recording, repeated until it is long enough for ``overlap`` integers from every start."""
        least = self.p.frame + self.p.hop * (len(SMOOTH) + IMAGE + self.p.overlap - 2)
        return np.tile(x, -(-least // len(x)))[:least] if 0 < len(x) < least else x

    @staticmethod
    def filtered(total: np.ndarray, n: int) -> np.ndarray:
        """The filters at the first ``n`` places of an image, given as its integral image."""

        def area(x0: int, y0: int, x1: int, y1: int) -> np.ndarray:
            return total[x1 : x1 + n, y1] - total[x0 : x0 + n, y1] - total[x1 : x1 + n, y0] + total[x0 : x0 + n, y0]

        out = np.zeros(n, np.uint32)
        for kind, y, h, w, thresholds in FILTERS:
            all_of = area(0, y, w, y + h)
            if kind == 0:
                a = all_of
            elif kind == 1:
                a = area(0, y + h // 2, w, y + h)
            elif kind == 2:
                a = area(w // 2, y, w, y + h)
            elif kind == 3:
                a = area(0, y + h // 2, w // 2, y + h) + area(w // 2, y, w, y + h // 2)
            elif kind == 4:
                a = area(0, y + h // 3, w, y + 2 * (h // 3))
            else:
                a = area(w // 3, y, 2 * (w // 3), y + h)
            b = 0.0 if kind == 0 else np.maximum(all_of - a, 0)
            # log(u / v) against thresholds, without the logarithm
            ratio = (1 + np.maximum(a, 0)) / (1 + b)
            level = sum((ratio >= np.exp(t)).astype(np.uint32) for t in thresholds)
            out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))
        return out


def fingerprints(media: DataFrame, params: Params, kind: str) -> DataFrame:
    """(id, payload) to (id, n, digest, phases): packed little-endian integers from each start, ``n`` and ``digest`` of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chroma = Chroma(params)
        for b in batches:
            found: list[list[bytes]] = []
            held: list[np.ndarray] = []
            for i, payload in enumerate(b.column(1), 1):
                held.append(chroma.looped(samples(payload.as_py(), kind)))
                if i == b.num_rows or sum(map(len, held)) >= CHUNK:
                    found += [[y.astype("<u4").tobytes() for y in x] for x in chroma.integers(held)]
                    held = []
            cols = [b.column(0), pa.array([len(f[0]) // 4 for f in found], pa.int64()), pa.array([hashlib.sha256(f[0] or (t.as_py() or b"")).digest() for f, t in zip(found, b.column(1))], pa.binary()), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(cols, ["id", "n", "digest", "phases"])

    return media.select("id", "payload").mapInArrow(run, "id long, n long, digest binary, phases array<binary>")


class Index:
    """The integers of a block of queries, in order of value."""

    def __init__(self, queries: list[tuple[int, bytes]]):
        self.ids = np.array([q for q, _ in queries], np.int64)
        self.ints = [np.frombuffer(x, "<u4") for _, x in queries]
        values = np.concatenate(self.ints) if queries else np.empty(0, np.uint32)
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.query = np.repeat(np.arange(len(queries)), [len(x) for x in self.ints])[order]
        self.place = np.concatenate([np.arange(len(x)) for x in self.ints])[order] if queries else values

    def aligned(self, own: int, x: np.ndarray, p: Params) -> list[tuple[int, int, int, float]]:
        """(query id, offset, overlap, share of differing bits) of the queries that align, the one of id ``own`` left out."""
        lo, hi = np.searchsorted(self.values, x), np.searchsorted(self.values, x, "right")
        many = hi - lo
        if not many.any():
            return []
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
        query, offset = self.query[at], np.repeat(np.arange(len(x)), many) - self.place[at]
        pairs, votes = np.unique((query.astype(np.int64) << 32) + (offset + (1 << 31)), return_counts=True)
        enough = votes >= p.votes
        pairs, votes = pairs[enough], votes[enough]
        query, offset = pairs >> 32, (pairs & 0xFFFFFFFF) - (1 << 31)
        order = np.lexsort((np.abs(offset), -votes, query))
        out, done = [], -1
        for q, o in zip(query[order].tolist(), offset[order].tolist()):
            if q == done or self.ids[q] == own:
                continue
            a, b = x[max(0, o) :], self.ints[q][max(0, -o) :]
            n = min(len(a), len(b))
            if n < p.overlap:
                continue
            wrong = float(np.bitwise_count(a[:n] ^ b[:n]).sum()) / (32 * n)
            if wrong <= p.error:
                out.append((int(self.ids[q]), o, n, wrong))
                done = q
        return out


def aligned(media: DataFrame, queries: DataFrame, params: Params, kind: str = "s16le") -> DataFrame:
    """(id, payload) and the ids searched for, to a row a recording.

    id, n_ints, class_id (the smallest id with the same fingerprint), n_links (query classes other than its own that
    align with it), and of the one with the fewest differing bits: best_query, best_offset (samples by which the query begins
    later in it), best_overlap (integers), best_error.
    """
    prints = written(fingerprints(media, params, kind), "chroma")
    of_class = F.xxhash64("digest").alias("class")
    classes = prints.groupBy("digest").agg(F.min("id").alias("class_id"), F.any_value("n").alias("n"), F.min_by("phases", F.struct(F.col("id").isNull(), "id")).alias("phases"))
    classes = written(classes.select(of_class, "*"), "classes")
    searched = prints.join(queries.select("id").distinct(), "id", "left_semi").select("digest").distinct()
    asked = classes.join(searched, "digest", "left_semi").where("n > 0").select("class", "class_id", "n", F.element_at("phases", 1).alias("ints"))
    blocks = max(1, -(-int(asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // BLOCK))
    asked = written(asked.withColumn("block", F.pmod("class", F.lit(blocks)).cast("int")), "queries", by="block")
    found, names = None, asked.select(F.col("class").alias("query"), F.col("class_id").alias("best_query"))
    for k in range(blocks):
        held = sorted((r[0], bytes(r[1])) for r in asked.where(F.col("block") == k).select("class", "ints").collect())

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Index(held)
            for b in batches:
                rows = []
                for own, phases in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    links: dict[int, tuple] = {}
                    for i, ints in enumerate(phases):
                        for q, offset, overlap, error in index.aligned(own, np.frombuffer(ints, "<u4"), params):
                            at = offset * params.hop + i * params.hop // params.phases
                            links[q] = min(links.get(q, (2.0, 0, 0, 0)), (error, -overlap, q, at))
                    if links:
                        rows.append((own, len(links), *min(links.values())))
                kinds = pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["class", "links", "error", "less", "query", "offset"])

        rows = classes.where("n > 0").select("class", "phases").mapInArrow(run, "class long, links long, error double, less long, query long, offset long")
        # a block's links are written before the next block is read, so that the driver holds one
        rows = written(rows, "aligned") if blocks > 1 else rows
        found = rows if found is None else found.unionByName(rows)
    links = found.groupBy("class").agg(F.sum("links").alias("n_links"), F.min(F.struct("error", "less", "query", "offset")).alias("best"))
    links = links.select("class", "n_links", "best.*").join(names, "query")
    named = classes.select("digest", "class", "class_id").join(links, "class", "left")
    return prints.select("id", "n", "digest").join(named, "digest").select(
        "id",
        F.col("n").alias("n_ints"),
        "class_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "best_query",
        F.col("offset").alias("best_offset"),
        (-F.col("less")).alias("best_overlap"),
        F.col("error").alias("best_error"),
    )


#: A document's bytes as 8-bit samples.
PARAMS = Params(rate=8000, frame=128, hop=32, lowest=60.0, highest=4000.0, phases=4, votes=2, overlap=8, error=0.15)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    media = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("payload"))
    asked = media.where(F.col("id") % 100 == 0).select("id")
    return aligned(media, asked, PARAMS, "u8").withColumnRenamed("id", "doc_id")
