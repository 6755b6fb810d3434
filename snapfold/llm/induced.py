"""Suffix arrays by induced sorting, with priority queues that go to disk.

Suffixes are L or S as they are larger or smaller than the one after them; the leftmost S suffixes (LMS) are sorted by
recursion on the string of their names, and all others are induced from them: whoever leaves the queue with the least key
sends its predecessor in. The queue holds positions in ranges of keys. What leaves it in one round is the longest run of
whole keys such that nothing sent in by the run belongs before its end, so that rounds are numpy operations on many
suffixes at once. Ranges above ``HELD`` entries go to an unlinked scratch file, and output arrays above ``RESIDENT`` bytes are
mapped from one; the text and a few arrays of its length stay in memory.

Common prefixes are not carried along: neighbours in the finished order are compared symbol by symbol (see ``suffixes.py``).
"""

from __future__ import annotations

import tempfile

import numpy as np

HELD, RESIDENT, RANGES = 1 << 21, 256 << 20, 512


def array(n: int, dtype) -> np.ndarray:
    """Zeros, in memory or mapped from a scratch file that is gone when the array is."""
    if n * np.dtype(dtype).itemsize <= RESIDENT:
        return np.zeros(n, dtype)
    with tempfile.TemporaryFile() as f:
        f.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(f, dtype, "r+", shape=(n,))


class Queue:
    """Positions by key range, first in first out within a key."""

    def __init__(self, bounds: np.ndarray):
        self.bounds = bounds
        self.lists: list[list] = [[] for _ in range(len(bounds) + 1)]
        self.held, self.file, self.spans = 0, None, {}

    def put(self, pos: np.ndarray, keys: np.ndarray) -> None:
        where = self.bounds.searchsorted(keys, "right")
        order = where.argsort(kind="stable")
        pos, where = pos[order], where[order]
        cuts = [0, *((where[1:] != where[:-1]).nonzero()[0] + 1).tolist(), len(pos)]
        for r, at, stop in zip(where[cuts[:-1]].tolist(), cuts, cuts[1:]):
            self.lists[r].append(pos[at:stop])
        self.held += len(pos)
        if self.held > HELD:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for r, parts in enumerate(self.lists):
            if parts:
                at = self.file.seek(0, 2)
                data = np.concatenate(parts)
                self.file.write(data.tobytes())
                self.spans.setdefault(r, []).append((at, len(data), data.dtype))
                self.lists[r] = []
        self.held = 0

    def take(self, r: int) -> np.ndarray | None:
        parts = []
        for at, n, dtype in self.spans.pop(r, []):
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(n * dtype.itemsize), dtype))
        own, self.lists[r] = self.lists[r], []
        self.held -= sum(map(len, own))
        parts += own
        return np.concatenate(parts) if parts else None


def _induce(rank: np.ndarray, seeds: np.ndarray, sign: int) -> np.ndarray:
    """All suffixes of one kind in order of leaving: L ascending from LMS (sign 1), S descending from L (sign -1).

    ``rank`` is twice a suffix's first symbol, and one more if it is S. Rounds are many and most are short, so what counts is how few
    calls a round makes.
    """
    want = sign < 0  # the kind that is sent in: S in the second pass
    key = rank
    if want:
        key = array(len(rank), rank.dtype)
        np.negative(rank, out=key)
    never = np.iinfo(key.dtype).max
    k = key[seeds]
    sample = np.sort(k[:: max(1, len(k) // (8 * RANGES))])
    bounds = np.unique(sample[:: max(1, len(sample) // RANGES)])[1:]
    queue = Queue(bounds)
    if len(seeds):
        queue.put(seeds, k)
    out, filled = array(len(rank), np.int32), 0
    for r in range(len(bounds) + 1):
        now = queue.take(r)
        if now is None:
            continue
        k = key[now]
        order = k.argsort(kind="stable")
        now, k = now[order], k[order]
        upper = bounds[r] if r < len(bounds) else None
        while len(now):
            before = now - 1
            sent = key[before]  # a negative key is as odd as its rank
            sends = (sent & 1) == want
            sends &= before >= 0
            sent[~sends] = never
            least = np.minimum.accumulate(sent)
            # the last place of a key up to which nothing sent in is less than the key
            fine = least >= k
            fine[:-1] &= k[1:] != k[:-1]
            m = len(k) - int(fine[::-1].argmax())
            gone = now[:m]
            kept = gone[(k[:m] & 1) == want]
            out[filled : filled + len(kept)] = kept
            filled += len(kept)
            sends = sends[:m]
            new, new_k = before[:m][sends], sent[:m][sends]
            now, k = now[m:], k[m:]
            if len(new):
                if upper is not None:
                    here = new_k < upper
                    away = ~here
                    if away.any():
                        queue.put(new[away], new_k[away])
                        new, new_k = new[here], new_k[here]
                if len(new):
                    mixed, mixed_k = np.concatenate((now, new)), np.concatenate((k, new_k))
                    order = mixed_k.argsort(kind="stable")
                    now, k = mixed[order], mixed_k[order]
    return out[:filled]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; the text's last symbol is smaller than all others."""
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable").astype(np.int32)
    # S suffixes: the next different symbol is larger
    step = np.sign(np.diff(text.astype(np.int64))).astype(np.int8)
    where = np.where(step != 0, np.arange(n - 1, dtype=np.int32), n)
    nearest = np.minimum.accumulate(where[::-1])[::-1]
    small = np.ones(n, bool)
    small[: n - 1] = np.where(nearest < n, step[np.minimum(nearest, n - 2)] > 0, False)
    del where, nearest, step
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)

    rank = array(n, np.int32 if text.max() < 1 << 29 else np.int64)
    rank[:] = text
    rank *= 2
    rank += small

    def order(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        large = _induce(rank, seeds, 1)
        return large, _induce(rank, large[::-1], -1)[::-1]

    if len(lms) > 1:
        _, s = order(lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        # the sentinel sends nothing in the second pass: it comes first of all
        by_piece = np.concatenate([[n - 1], s[is_lms[s] & (s != n - 1)]]).astype(np.int32)
        names = _names(text, is_lms, by_piece)
        if names[-1] + 1 < len(lms):
            place = np.empty(n, np.int32)
            place[by_piece] = names
            lms = lms[suffix_array(place[lms])]
        else:
            lms = by_piece
    large, s = order(lms)
    s = np.concatenate([[n - 1], s[s != n - 1]]).astype(np.int32)
    both = np.concatenate([large, s])
    return both[rank[both].argsort(kind="stable")]


def _names(text: np.ndarray, is_lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the LMS pieces in their order; equal pieces share one."""
    a, b = order[:-1], order[1:]
    same = np.ones(len(a), bool)
    live = np.arange(len(a))
    k = 0
    n = len(text)
    while len(live):
        x, y = a[live] + k, b[live] + k
        inside = (x < n) & (y < n)
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        equal = inside & (text[x] == text[y])
        both, either = is_lms[x] & is_lms[y], is_lms[x] | is_lms[y]
        over = equal & (k > 0) & both
        fail = ~equal | ((k > 0) & either & ~both)
        same[live[fail]] = False
        live = live[~(fail | over)]
        k += 1
    return np.concatenate([[0], np.cumsum(~same)])
