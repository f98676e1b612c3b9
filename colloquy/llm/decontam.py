"""Benchmark decontamination by CGK embedding and bit sampling (operator 8).

A CGK walk reads a word sequence with a pointer that, at every step, stays or
moves on by a random bit of (step, word): words in edit distance become words
in Hamming distance, and an insertion or deletion is forgotten once two walks
fall into step again.  Each repetition walks from every window of the corpus
and from a random word of each item, samples a few positions of
the embedding and looks for equal samples; the samples are compared one after
another, so that most windows end after the first.  Walks that move at every
step start at the pieces of each item, one more than its allowed edits: every
copy leaves one piece untouched, so none is missed.  Every hit is verified by
the exact edit distance between the item and the best fitting part of the
window.  All windows of a document are in one row, so nothing is shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ddl, map_arrow

SIMILARITY = 0.8
LEAST_WORDS = 5
REPETITIONS = 16
SAMPLES = (0, 2, 7, 13)      # upper ends of the ranges the sampled steps are drawn from
ITEMS_PER_PASS = 50_000
BATCH_WORDS = 2_000_000
_MARKS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII marks and white space part them."""
    return (text or "").lower().encode("utf-8").translate(_MARKS).split()


def best_distance(item: list[int], text: list[int]) -> int:
    """Smallest edit distance of ``item`` to any part of ``text`` (Myers'
    bit-vector recurrence, free start and end)."""
    m = len(item)
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for w in text:
        eq = masks.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        score += 1 if ph & top else -1 if mh & top else 0
        best = min(best, score)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
    return best


class Index:
    """The item side: vocabulary, random walks and sampled signatures."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, repetitions: int, seed: int = 8):
        self.vocab: dict[bytes, int] = {}
        self.items: list[tuple[int, list[int], int]] = []        # item_id, words, most edits
        for item_id, text in items:
            words = words_of(text)
            if len(words) >= LEAST_WORDS:
                ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
                self.items.append((item_id, ids, int((1 - similarity) * len(ids) + 1e-9)))
        self.distinct = [frozenset(ids) for _, ids, _ in self.items]
        rng = np.random.default_rng(seed)
        self.n_words = len(self.vocab) + 1
        self.gap = SAMPLES[-1] + 2
        self.reps = []
        if not self.items:
            return
        sizes = np.array([len(ids) for _, ids, _ in self.items])
        self.flat = np.concatenate([np.array(ids + [0] * self.gap) for _, ids, _ in self.items])
        self.at = np.cumsum(sizes + self.gap) - sizes - self.gap
        for length, places in self._pieces().items():
            self._add(places, list(range(length)), np.ones((length, self.n_words), np.uint8))
        for _ in range(repetitions):
            steps = [0, *(int(rng.integers(a + (k > 0), b + 1)) for k, (a, b) in enumerate(zip(SAMPLES, SAMPLES[1:])))]
            steps = sorted(set(steps))
            bits = rng.integers(0, 2, (steps[-1] + 1, self.n_words), dtype=np.uint8)
            starts = rng.integers(0, np.maximum(1, sizes - SAMPLES[-1] // 2))
            self._add(list(enumerate(starts.tolist())), steps, bits)

    def _pieces(self) -> dict[int, list[tuple[int, int]]]:
        """Sampled words -> (item number, first word) of every item cut into one
        piece more than it may have edits: one of them is untouched."""
        out: dict[int, list[tuple[int, int]]] = {}
        for k, (_, ids, most) in enumerate(self.items):
            cuts = [len(ids) * c // (most + 1) for c in range(most + 2)]
            for a, b in zip(cuts, cuts[1:]):
                out.setdefault(min(b - a, SAMPLES[-1]), []).append((k, a))
        return out

    def _add(self, places: list[tuple[int, int]], steps: list[int], bits: np.ndarray) -> None:
        """One repetition: walks from ``places`` (item number, first word) by
        ``bits``, sampled at ``steps``."""
        at = self.at[[k for k, _ in places]] + [o for _, o in places]
        levels, keys, ptr, prev = [], None, at, 0
        for j in steps:
            ptr = self._walk(self.flat, ptr, bits, prev, j)
            keys = self._key(keys, self.flat[ptr])
            levels.append(np.unique(keys))
            prev = j
        first = np.zeros(self.n_words, bool)
        first[self.flat[at]] = True
        by_key: dict[int, list[tuple[int, int]]] = {}
        for key, place in zip(keys.tolist(), places):
            by_key.setdefault(key, []).append(place)
        self.reps.append((steps, bits, first, levels, by_key))

    @staticmethod
    def _walk(symbols, ptr, bits, a: int, b: int):
        for j in range(a, b):
            ptr = ptr + bits[j][symbols[ptr]]
        return ptr

    @staticmethod
    def _key(keys, symbols):
        symbols = symbols.astype(np.uint64)
        mixed = symbols + np.uint64(1) if keys is None else keys * np.uint64(0x9E3779B97F4A7C15) + symbols + np.uint64(1)
        return mixed ^ (mixed >> np.uint64(29))

    def hits(self, symbols: np.ndarray):
        """(window start, item number, walk start) of equal signatures, as places in symbols."""
        found = set()
        for steps, bits, first, levels, by_key in self.reps:
            start = np.flatnonzero(first[symbols])
            ptr, prev, keys = start, 0, None
            for j, level in zip(steps, levels):
                ptr = self._walk(symbols, ptr, bits, prev, j)
                keys = self._key(keys, symbols[ptr])
                at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
                ok = level[at] == keys
                start, ptr, keys, prev = start[ok], ptr[ok], keys[ok], j
                if not len(start):
                    break
            for p, key in zip(start.tolist(), keys.tolist() if len(start) else ()):
                found.update((p - o, k, p) for k, o in by_key[key])
        return sorted(found)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text number, item_id, distance, item words) of every text and item
        within the distance."""
        if not self.items:
            return []
        out = []
        get = self.vocab.get
        parts, bounds, at, first = [], [], 0, 0
        pad = np.zeros(self.gap, np.int32)

        def flush():
            symbols = np.concatenate([*parts, pad])
            ends = np.array([b[1] for b in bounds])
            best: dict[tuple[int, int], int] = {}
            hits = self.hits(symbols)
            # a window may begin before its document: the walk's start is always inside
            docs = np.searchsorted(ends, np.array([p for _, _, p in hits], int), "right").tolist()
            for doc, k, s in sorted({(doc, k, s) for doc, (s, k, _) in zip(docs, hits)}):
                _, ids, most = self.items[k]
                lo, hi = bounds[doc]
                if best.get((doc, k), len(ids)) == 0:
                    continue
                region = symbols[max(lo, s - most):min(hi, s + len(ids) + most)].tolist()
                # an edit takes away one distinct word at most
                if len(self.distinct[k].intersection(region)) < len(self.distinct[k]) - most:
                    continue
                d = best_distance(ids, region)
                if d <= most and d < best.get((doc, k), most + 1):
                    best[doc, k] = d
            out.extend((first + doc, self.items[k][0], d, len(self.items[k][1])) for (doc, k), d in sorted(best.items()))

        for n, text in enumerate(texts):
            words = words_of(text)
            symbols = np.array([get(w, 0) for w in words], np.int32)
            if parts and at + len(symbols) > BATCH_WORDS:
                flush()
                parts, bounds, at, first = [], [], 0, n
            # the gap before a document keeps windows that begin before it apart
            parts += [pad, symbols]
            bounds.append((at + self.gap, at + self.gap + len(symbols)))
            at += self.gap + len(symbols)
        if parts:
            flush()
        return out


MATCHES = "doc_id long, item_id long, distance int, item_words int"


def _indexes(items: DataFrame, similarity: float, repetitions: int, items_per_pass: int):
    """One index per pass over the documents."""
    text = items.select("item_id", "text").filter(F.col("text").isNotNull())
    bound = text.count()
    passes = max(1, -(-bound // items_per_pass))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    for p in range(passes):
        rows = sorted((r.item_id if r.item_id is not None else -1, r.text, r.item_id is None)
                      for r in text.filter(part == p).collect())
        yield Index([(None if null else i, t) for i, t, null in rows], similarity, repetitions)


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY,
            repetitions: int = REPETITIONS, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """doc_id, item_id, distance, item_words: one row per document row and
    benchmark item of which the document holds a passage within
    (1 - similarity) x words edits (words inserted, deleted, replaced).

    Null texts hold nothing; items of under ``LEAST_WORDS`` words are no
    evidence; repeated rows answer each for themselves.  The items are read in
    passes of at most ``items_per_pass``, one scan of the documents each."""
    out = None
    for index in _indexes(items, similarity, repetitions, items_per_pass):
        def step(batch, index=index):
            ids = batch.column(0)
            found = index.search(batch.column(1).to_pylist())
            if not found:
                return None
            at = pa.array([f[0] for f in found], pa.int64())
            return {"doc_id": ids.take(at), "item_id": [f[1] for f in found], "distance": [f[2] for f in found],
                    "item_words": [f[3] for f in found]}

        got = map_arrow(docs.select("doc_id", "text"), step, MATCHES)
        out = got if out is None else out.unionByName(got)
    return out


def clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY,
          repetitions: int = REPETITIONS, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage, each row
    by its own text, whatever its doc_id."""
    names, at = docs.columns, docs.columns.index("text")
    schema = ddl(docs)
    for index in _indexes(items, similarity, repetitions, items_per_pass):
        def step(batch, index=index):
            held = {f[0] for f in index.search(batch.column(at).to_pylist())}
            kept = batch.filter(pa.array([n not in held for n in range(batch.num_rows)], pa.bool_()))
            return dict(zip(names, kept.columns))

        docs = map_arrow(docs, step, schema)
    return docs
