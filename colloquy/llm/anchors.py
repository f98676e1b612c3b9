"""Content-chosen anchors: every ``length``-byte window of a text picks the gram
with the smallest hash inside it, so equal windows pick equal grams at equal
places.  An anchor owns the run of neighbouring windows that picked it."""

from __future__ import annotations

import numpy as np

GRAM = 32
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, n.bit_length())
        made = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.ones(size, np.uint64)
            steps[1:] = np.uint64(x)
            made.append(np.multiply.accumulate(steps))
        _POWERS[:] = made
    return _POWERS


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class RangeHash:
    """64-bit polynomial hashes of byte ranges of one array."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def grams(self, width: int) -> np.ndarray:
        """Of every range of ``width`` bytes, not mixed."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start])


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM):
    """Runs of windows over documents laid end to end (``ends``: where each
    stops).  Returns (ranges, document, gram hash, gram position, first window,
    last window); positions are in ``data``."""
    none = np.empty(0, np.int64)
    n = len(data) - length + 1
    ranges = RangeHash(data)
    if n <= 0:
        return ranges, none, none.astype(np.uint64), none, none, none
    # the high bits of a gram's hash order it; its place in its block breaks
    # ties towards the left
    span = length - gram + 1
    bits = np.uint64((span - 1).bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    grams = ranges.grams(gram)
    blocks = -(-(len(grams) + span) // span)
    key = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    key[:len(grams)] = grams
    key = key.reshape(blocks, span)
    key &= ~mask
    key |= np.arange(span, dtype=np.uint64)
    right = np.minimum.accumulate(key, axis=1).ravel()                        # from the block's start
    left = np.ascontiguousarray(np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1]).ravel()   # to its end
    a, b = left[:n], right[span - 1:span - 1 + n]
    s = np.arange(n)
    base = np.repeat(np.arange(0, blocks * span, span), span)[:n]
    first = (a | mask) <= (b | mask)
    pick = np.where(first, base + (a & mask).astype(np.int64), base + span + (b & mask).astype(np.int64))
    pick[::span] = np.arange(0, n, span) + (a[::span] & mask).astype(np.int64)  # the window is the block
    starts = ends - np.diff(np.concatenate(([0], ends)))
    valid = np.zeros(n + 1, np.int32)
    long = ends - starts >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    valid = np.cumsum(valid[:n]) > 0
    # a run ends where the pick or the document changes
    change = np.ones(n, bool)
    change[1:] = pick[1:] != pick[:-1]
    edges = starts[starts < n]
    change[edges] = True
    change[1:] |= valid[1:] != valid[:-1]
    at = np.flatnonzero(change)
    stop = np.append(at[1:], n) - 1
    keep = valid[at]
    lo, hi = s[at[keep]], stop[keep]
    p = pick[lo]
    return ranges, np.searchsorted(ends, lo, "right"), _mix(grams[p]), p, lo, hi


def cover_hash(ranges: RangeHash, p, lo, hi, length: int) -> np.ndarray:
    """Hash of the bytes that runs cover, and of where the anchor stands in them."""
    return _mix(ranges.of(lo, hi + length) + (p - lo).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                + (hi - lo).astype(np.uint64))
