"""Document quality from line labels of a linear-chain CRF (operator 10).

Every line of a text is labelled good or bad by a two-state linear-chain
conditional random field over the features of the line and its two neighbours.
Forward-backward marginals, weighted by line length, give the share of good
text; a logistic map turns the share into the score.  Only document labels
exist for training, so lines of good documents are good, and lines of bad
documents are relabelled from the model's own marginals between fits."""

from __future__ import annotations

import operator
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ddl, map_arrow

TRAIN_DOCS = 3000          # bound of the labelled sample a model is fitted on
CHUNK = 64                 # training sequences are cut into so many lines
REFITS = 2
STEPS = 60

# Byte classes: 0 other mark, 1 lower, 2 upper, 3 digit, 4 space, 5 beyond
# ASCII, 6 sentence mark, 7 '!', 8 one of #$%&*, 9 '|'
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[128:] = 5
_CLASS[[44, 46, 58, 59, 63]] = 6
_CLASS[33] = 7
_CLASS[[35, 36, 37, 38, 42]] = 8
_CLASS[124] = 9
FEATURES = 20


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, weights) of a whole text; null and empty texts are
    one empty line.  A line's weight is its length, 1 at least."""
    text = text or ""
    lines = text.split("\n")
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    breaks = raw == 10
    line_of = np.cumsum(breaks) - breaks
    n = len(lines)
    counts = np.bincount(line_of * 10 + _CLASS[raw], minlength=10 * n).reshape(n, 10).astype(float)
    counts[:-1, 0] -= 1          # the line break itself
    size = np.maximum(counts.sum(1), 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2] + counts[:, 5], 1)
    f = np.zeros((n, FEATURES))
    f[:, 0] = np.log1p(size) / 10
    f[:, 1:11] = counts / size[:, None]
    f[:, 11] = counts[:, 2] / letters
    seen = Counter(lines)
    for k, line in enumerate(lines):
        words = line.split()
        m = len(words)
        if m:
            own = set(words)
            f[k, 12] = len(own) / m
            f[k, 13] = sum(map(operator.eq, words, words[1:])) / m
            f[k, 14] = min(2.0, len(line) / m / 10)
            f[k, 15] = np.log1p(m) / 10
            f[k, 16] = line[-1] in ".!?"
            f[k, 17] = line[:1].isupper()
            f[k, 18] = sum(1 for w in words if len(w) < 4) / m
        f[k, 19] = (seen[line] - 1) / n
    return f, size


def _around(f: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features and a constant; zeros outside."""
    none = np.zeros((1, f.shape[1]))
    return np.hstack([f, np.vstack([none, f[:-1]]), np.vstack([f[1:], none]), np.ones((len(f), 1))])


def marginals(scores: list[np.ndarray], trans: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Forward-backward over many sequences at once, in groups of like length.
    ``scores``: per line the log odds of good.  Returns P(good) per line, the
    expected transition counts and the sum of the log partition sums."""
    out: list = [None] * len(scores)
    pairs, logz = np.zeros((2, 2)), 0.0
    groups: dict[int, list[int]] = {}
    for k, s in enumerate(scores):
        groups.setdefault(max(1, len(s) - 1).bit_length(), []).append(k)
    step = np.exp(trans - trans.max())
    for members in groups.values():
        lens = np.array([len(scores[k]) for k in members])
        top = int(lens.max())
        emit = np.zeros((top, len(members), 2))
        live = np.arange(top)[:, None] < lens
        for j, k in enumerate(members):
            emit[:lens[j], j, 1] = scores[k]
        peak = emit.max(2)
        emit = np.exp(emit - peak[..., None])
        alpha, beta, norm = np.zeros_like(emit), np.ones_like(emit), np.ones((top, len(members)))
        for t in range(top):
            a = emit[t] if t == 0 else (alpha[t - 1] @ step) * emit[t]
            norm[t] = np.where(live[t], a.sum(1), 1.0)
            alpha[t] = np.where(live[t][:, None], a / norm[t][:, None], alpha[t - 1] if t else 0)
        for t in range(top - 2, -1, -1):
            b = (beta[t + 1] * emit[t + 1]) @ step.T / norm[t + 1][:, None]
            beta[t] = np.where(live[t + 1][:, None], b, 1.0)
        both = alpha * beta
        good = both[..., 1] / both.sum(2)
        for j, k in enumerate(members):
            out[k] = good[:lens[j], j]
        if top > 1:
            joint = alpha[:-1][..., None] * step * (beta[1:] * emit[1:] / norm[1:][..., None])[:, :, None, :]
            joint = joint * live[1:][..., None, None]
            pairs += joint.sum((0, 1))
        logz += float((np.log(norm) * live).sum() + (peak * live).sum() + trans.max() * (lens - 1).sum())
    return out, pairs, logz


def _fit_crf(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weights: np.ndarray, trans: np.ndarray):
    """Adam on the conditional log likelihood with an L2 term."""
    seen = np.zeros((2, 2))
    inner = np.ones(len(y), bool)
    inner[bounds[:-1]] = False
    at = np.flatnonzero(inner)
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    theta = np.concatenate([weights, trans.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        w, tr = theta[:-4], theta[-4:].reshape(2, 2)
        odds = x @ w
        p, pairs, _ = marginals(np.split(odds, bounds[1:-1]), tr)
        grad = np.concatenate([x.T @ (y - np.concatenate(p)), (seen - pairs).ravel()]) / len(y) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


class QualityModel:
    """Weights, transitions and the logistic map from good share to score."""

    def __init__(self, weights, trans, mean, scale, slope, shift):
        self.weights, self.trans, self.mean, self.scale = weights, trans, mean, scale
        self.slope, self.shift = slope, shift

    def shares(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted share of good text of each document."""
        odds = [_around((f - self.mean) / self.scale) @ self.weights for f, _ in docs]
        p, _, _ = marginals(odds, self.trans)
        return np.array([float(a @ w / w.sum()) for a, (_, w) in zip(p, docs)])

    def scores(self, docs) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.shares(docs) + self.shift)))


class ConstantModel:
    """Used when the sample has no rows or one class only: the smoothed rate."""

    def __init__(self, value: float):
        self.value = value

    def scores(self, docs) -> np.ndarray:
        return np.full(len(docs), self.value)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps of a ridge logistic regression of y on x."""
    a = np.stack([x, np.ones_like(x)], 1)
    b = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ b))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-2 * np.eye(2)
        b = b + np.linalg.solve(h, a.T @ (y - p) - 1e-2 * b)
    return float(b[0]), float(b[1])


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray):
    """The model of documents (features, weights) with labels 0 / 1."""
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return ConstantModel((labels.sum() + 1) / (len(labels) + 2))
    every = np.vstack([f for f, _ in docs])
    mean, scale = every.mean(0), every.std(0) + 1e-6
    x = np.vstack([_around((f - mean) / scale) for f, _ in docs])
    sizes = np.array([len(f) for f, _ in docs])
    doc_of = np.repeat(np.arange(len(docs)), sizes)
    within = np.concatenate([np.arange(n) for n in sizes])
    bounds = np.append(np.flatnonzero(within % CHUNK == 0), len(x))
    y = labels[doc_of]
    weights, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    for _ in range(REFITS):
        weights, trans = _fit_crf(x, bounds, y, weights, trans)
        p = np.concatenate(marginals(np.split(x @ weights, np.cumsum(sizes)[:-1]), trans)[0])
        lowest = np.minimum.reduceat(p, np.cumsum(sizes) - sizes)
        # a line of a bad document stays bad if the model doubts it, or if no
        # line of its document is worse
        y = np.where(labels[doc_of] == 1, 1.0, ((p > 0.6) & (p > lowest[doc_of])).astype(float))
    model = QualityModel(weights, trans, mean, scale, 1.0, 0.0)
    model.slope, model.shift = _logistic(model.shares(docs), labels)
    return model


def held_out(doc_id):
    """True where crc32 of the id as text leaves 1 when divided by 3 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, n_docs: int = TRAIN_DOCS):
    """A model from labelled rows (doc_id, quality) that are not held out: the
    ``n_docs`` first by a hash of the id.  Labels other than 0 and 1, null ids
    and labels without a document are not used."""
    picked = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select("doc_id", F.col("quality").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(n_docs))

    def step(batch):
        made = [line_features(t) for t in batch.column(0).to_pylist()]
        return {"f": [f.astype("<f4").tobytes() for f, _ in made], "w": [w.astype("<f4").tobytes() for _, w in made],
                "y": batch.column(1), "k": batch.column(2)}

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "y", "doc_id")
    got = sorted(map_arrow(rows, step, "f binary, w binary, y int, k long").collect(), key=lambda r: (r.k, r.y, r.f))
    made = [(np.frombuffer(r.f, "<f4").reshape(-1, FEATURES).astype(float), np.frombuffer(r.w, "<f4").astype(float))
            for r in got]
    return fit(made, np.array([r.y for r in got]))


def scored(docs: DataFrame, model) -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1); null texts score as empty ones."""
    names = docs.columns

    def run(batch):
        cols = {n: batch.column(i) for i, n in enumerate(names)}
        texts = cols["text"].to_pylist()
        return {**cols, "score": pa.array(model.scores([line_features(t) for t in texts]), pa.float64())}

    return map_arrow(docs, run, ddl(docs)
                     + ", score double")


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, score for every row of docs (doc_id, text)."""
    return scored(docs.select("doc_id", "text"), model).select("doc_id", "score")
