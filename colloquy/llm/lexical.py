"""Exact ranked lexical search by a dual-tree walk (operator 11).

Documents and items are vectors over the items' terms.  Both sides are put in
hierarchies whose nodes hold the largest value of every coordinate: documents
are range-sorted by their heaviest terms and grouped into leaves, nodes of
leaves and chunks; items likewise.  The product of the maxima of two nodes
bounds every score between them.  A pair of nodes is left out, with all it
holds, where that bound is under the weakest k-th score of the node's items;
what is left at the leaves is scored exactly, best bound first, so that the
k-th scores rise early.  All values are whole numbers, so bounds are exact.

Items are a stated query set: they are taken in blocks of bounded size, and
every block meets all documents."""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import _arrow_schema, map_arrow, settle, to_batch

BLOCK_BYTES = 1 << 18      # text of the items that are searched for at a time
ITEM_GROUP = 16            # items of a node
DOC_LEAF = 8
FANOUT = 16                # document leaves of a node
AT_ONCE = 16               # leaves that are scored between two looks at the k-th score
CHUNK_DOCS = 1024          # documents under one root
CHUNK_CELLS = 1 << 22      # their coordinates, zeros included (one leaf at least)
SLICES = 32                # the first k-th scores come from one slice of the documents

# A term is a run of ASCII letters, ASCII digits and anything beyond ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a whole UTF-8 text, A-Z lower-cased (null: none)."""
    return text.translate(_FOLD).split() if text else []


def _utf8(column) -> list:
    return column.cast(pa.binary()).to_pylist()


def _vectors(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, its number of terms, its terms of
    ``vocab`` (ids) and how often they occur, and the number of its slice."""

    def step(batch):
        out = ([], [], [], [], [])
        for doc, text in zip(batch.column(0).to_pylist(), _utf8(batch.column(1))):
            words = terms(text)
            if words:
                held = Counter(map(vocab.get, words))
                held.pop(None, None)
                ids = np.array(sorted(held), "<u4")
                tf = np.array([held[i] for i in ids.tolist()], "<u4")
                for col, v in zip(out, (doc, len(words), ids.tobytes(), tf.tobytes(), len(out[0]))):
                    col.append(v)
        return dict(zip(("doc_id", "n", "ids", "tf", "slice"), out))

    return map_arrow(docs.select("doc_id", "text"), step, "doc_id long, n long, ids binary, tf binary, slice int")


def _holders(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents holding each term: summed per task, then per term."""

    def count(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=n_terms)
        at = np.flatnonzero(df)
        yield to_batch({"term": at, "df": df[at]}, schema)

    schema = _arrow_schema(vectors.sparkSession, "term int, df long")
    df = np.zeros(n_terms, np.int64)
    for r in vectors.select("ids").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        df[r[0]] = r[1]                                       # one row a term of the block
    return df


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one point of a term's weight is worth in documents of ``n`` terms
    that hold the term ``tf`` times."""
    n = n.astype(object) if 75 * int(n.max(initial=0)) * n_docs >= 1 << 63 else n.astype(np.int64)
    m = (25 + 75 * n * n_docs // n_terms).astype(np.int64)
    return 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * m)


def _rows_of(binary: list) -> tuple[np.ndarray, np.ndarray]:
    """Packed rows as one flat array and the row bounds."""
    return np.frombuffer(b"".join(binary), "<u4"), np.concatenate([[0], np.cumsum([len(x) // 4 for x in binary])])


def _scored(vectors: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """The vectors with impacts for counts, and the two heaviest terms of each
    document, by which like documents come to lie together."""

    def step(batch):
        flat, at = _rows_of(batch.column(2).to_pylist())
        tf, _ = _rows_of(batch.column(3).to_pylist())
        n = np.repeat(batch.column(1).to_numpy(), np.diff(at))
        worth = impacts(tf, n, n_docs, n_terms).astype("<u4")
        first, second, packed = [], [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            gain = weights[flat[a:b]] * worth[a:b]
            top = flat[a:b][np.argsort(-gain, kind="stable")[:2]].tolist()
            first.append(top[0])
            second.append(top[1] if len(top) > 1 else -1)
            packed.append(worth[a:b].tobytes())
        return {"doc_id": batch.column(0), "ids": batch.column(2), "worth": packed, "slice": batch.column(4),
                "first": first, "second": second}

    return map_arrow(vectors.filter(F.length("ids") > 0), step,
                     "doc_id long, ids binary, worth binary, slice int, first int, second int")


class ItemTree:
    """Items under groups of like items under one root; every node has the
    terms of its items and their largest values."""

    def __init__(self, counts: list[dict[int, int]], weights: np.ndarray):
        self.size, self.top = len(counts), np.zeros(len(weights), np.int64)
        vectors = [{t: c * int(weights[t]) for t, c in item.items()} for item in counts]
        heavy = [sorted(v, key=lambda t: (-v[t], t))[:2] for v in vectors]
        order = sorted(range(self.size), key=lambda i: heavy[i])

        def node(items: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            most: dict[int, int] = {}
            for i in items:
                for t, v in vectors[i].items():
                    most[t] = max(v, most.get(t, 0))
            ids = np.array(sorted(most), np.int64)
            return np.array(items), ids, np.array([most[t] for t in ids.tolist()], np.int64)

        self.root = node(order)
        self.top[self.root[1]] = self.root[2]
        members = [order[a:a + ITEM_GROUP] for a in range(0, self.size, ITEM_GROUP)]
        self.groups = [(node(items), [node([i]) for i in items]) for items in members]


class Best:
    """The k best documents of every item so far, and each item's bar: what a
    score must reach to matter."""

    def __init__(self, n_items: int, k: int, bars: np.ndarray):
        self.k, self.bars = k, np.maximum(bars, 1)
        self.found: list = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(n_items)]

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = np.concatenate([self.found[item][0], docs]), np.concatenate([self.found[item][1], scores])
        top = np.lexsort((docs, -scores))[:self.k]
        self.found[item] = docs[top], scores[top]
        if len(top) == self.k:
            self.bars[item] = max(self.bars[item], scores[top[-1]])


def walk(tree: ItemTree, best: Best, docs: np.ndarray, ids: np.ndarray, worth: np.ndarray, at: np.ndarray, kind) -> int:
    """One chunk of documents (ids and values flat, row bounds ``at``) against
    all items; returns how many (item, document) scores were computed."""
    n, dim, done = len(docs), len(tree.top), 0
    row = np.repeat(np.arange(n), np.diff(at))
    # coordinates of documents, leaves, nodes and the root, one row a term
    values = np.zeros((dim, n), kind)
    values[ids, row] = worth
    leaves = np.zeros((dim, -(-n // DOC_LEAF)), kind)
    np.maximum.at(leaves, (ids, row // DOC_LEAF), worth)
    nodes = np.maximum.reduceat(leaves, np.arange(0, leaves.shape[1], FANOUT), axis=1)
    node_of = np.arange(leaves.shape[1]) // FANOUT

    def bound(node, level: np.ndarray) -> np.ndarray:
        return node[2].astype(kind) @ level[node[1]]

    if bound(tree.root, nodes.max(1, keepdims=True))[0] < best.bars.min():
        return done
    for group, items in tree.groups:
        near = bound(group, nodes) >= best.bars[group[0]].min()
        if not near.any():
            continue
        for item in items:
            i = int(item[0][0])
            reach = np.where(near[node_of], bound(item, leaves), 0)
            left = np.flatnonzero(reach >= best.bars[i])
            left = left[np.argsort(-reach[left], kind="stable")]
            while len(left) and reach[left[0]] >= best.bars[i]:
                own = (left[:AT_ONCE, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
                own, left = own[own < n], left[AT_ONCE:]
                scores = item[2].astype(kind) @ values[item[1][:, None], own]
                done += len(own)
                hit = np.flatnonzero(scores >= best.bars[i])
                if len(hit):
                    best.add(i, docs[own[hit]], scores[hit].astype(np.int64))
    return done


_NO_ID = np.iinfo(np.int64).max


def _search(vectors: DataFrame, tree: ItemTree, k: int, bars: np.ndarray) -> DataFrame:
    """item (its number), doc_id, score: the best of every task's documents."""
    # whole numbers in doubles while every sum stays exact in them
    kind = np.float64 if float(tree.top.sum()) * 1e6 < 2 ** 53 else np.int64
    schema = _arrow_schema(vectors.sparkSession, "item int, doc_id long, score long")

    def run(batches):
        best = Best(tree.size, k, bars)
        step = max(DOC_LEAF, min(CHUNK_DOCS, CHUNK_CELLS // len(tree.top)))
        for batch in batches:
            docs = batch.column(0).fill_null(_NO_ID).to_numpy()
            ids, at = _rows_of(batch.column(1).to_pylist())
            worth, _ = _rows_of(batch.column(2).to_pylist())
            for a in range(0, len(docs), step):
                b = min(a + step, len(docs))
                walk(tree, best, docs[a:b], ids[at[a]:at[b]].astype(np.int64), worth[at[a]:at[b]], at[a:b + 1] - at[a], kind)
        item = np.repeat(np.arange(tree.size), [len(d) for d, _ in best.found])
        doc = np.concatenate([d for d, _ in best.found] or [np.empty(0, np.int64)])
        score = np.concatenate([s for _, s in best.found] or [np.empty(0, np.int64)])
        yield to_batch({"item": item, "doc_id": pa.array(doc, mask=doc == _NO_ID), "score": score}, schema)

    found = vectors.select("doc_id", "ids", "worth").mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents
    (doc_id, text) of every item (item_id, text), scores above 0 only, equal
    scores by ascending doc_id.

    Every row is a document; null and empty texts have no term and count
    nowhere; rows without a doc_id rank after all others of the same score.
    Equal rows of ``items`` are one item; different texts of one item_id (or of
    none) have a list each.  Other columns are not read; an empty table on
    either side gives no rows."""
    spark = docs.sparkSession
    asked = settle(items.select("item_id", "text").filter("text IS NOT NULL").distinct(), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = []
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()    # about BLOCK_BYTES
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
        counted = [(r[0], Counter(terms(r[1].encode("utf-8", "surrogatepass")))) for r in rows]
        counted = [(i, c) for i, c in counted if c]
        if counted:
            out.append(_block(docs, counted, k))
    result = reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result.select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, counted: list, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocab = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    vectors = settle(_vectors(docs, vocab), "lexical-vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    df = _holders(vectors, len(vocab)).tolist()
    weights = np.array([weight(n_docs, d) for d in df], np.int64)
    tree = ItemTree([{vocab[t]: c for t, c in held.items()} for _, held in counted], weights)
    # the k-th scores within one slice bound those of all documents from below
    bars = np.zeros(len(counted), np.int64)
    one = _scored(vectors.filter(F.pmod("slice", F.lit(SLICES)) == 0), weights, n_docs, n_terms)
    for r in _search(one, tree, k, bars).filter(F.col("rank") == k).select("item", "score").collect():
        bars[r[0]] = r[1]                                     # one row an item of the block
    ordered = _scored(vectors, weights, n_docs, n_terms).repartitionByRange("first", "second", "slice").sortWithinPartitions("first", "second", "slice")
    ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(counted)], "item int, item_id long")
    return settle(_search(ordered, tree, k, bars).join(F.broadcast(ids), "item"), "lexical-best")
