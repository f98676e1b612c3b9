"""Vector codes by memoised grid cells (operator 12).

Vectors of whole numbers are cut into parts; every part position has a small
codebook, refined by rounds of nearest-entry assignment.  Space is a grid: a
part's components fall into one coarse cell.  For a cell, an entry whose least
distance to the cell's box is above the smallest greatest distance of any entry
can be nearest to no point of it; the other entries are remembered under the
cell's hash, once per worker and codebook.  A part evaluates exactly only the
entries of its cell, so assignments are those of a full scan.

Only per-entry counts and sums leave the tasks between rounds."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import _arrow_schema, settle, to_batch

FACTOR = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL_MEMO = 1 << 16         # cells a worker remembers for one part position
SIDE = 0.7                 # a cell's side over the entries' spread in one component
BLOCK_ROWS = 2048          # rows whose cells are looked up at a time
# squared distances fit 64-bit integers while components stay below this
SMALL = 1 << 23


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v: floor(4096 * x) per component as a whole double.
    Vectors that are null or hold null or non-finite components are dropped."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    usable = F.col("embedding").isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    # FLOOR gives a long; from 2^40 on the scaled numbers are whole anyway
    whole = F.transform(x, lambda e: F.when(F.abs(e) < float(1 << 40), F.floor(e * FACTOR).cast("double")).otherwise(e * FACTOR))
    return vectors.filter(F.coalesce(usable, F.lit(False))).select("vec_id", "label", whole.alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as whole numbers, short rows padded with zeros:
    64-bit integers where squared distances fit them, else Python's."""
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    flat = flat[at[0]:at[-1]]
    small = not len(flat) or np.abs(flat).max() < SMALL
    out = np.zeros((len(column), dim), np.int64 if small else object)
    row = np.repeat(np.arange(len(column)), np.diff(at))
    out[row, np.arange(len(flat)) - np.repeat(at[:-1] - at[0], np.diff(at))] = (
        flat.astype(np.int64) if small else [int(x) for x in flat.tolist()])
    return out


def _cell_hash(cell: np.ndarray) -> np.ndarray:
    out = np.full(len(cell), 0x9E3779B97F4A7C15, np.uint64)
    for j in range(cell.shape[1]):
        out = (out ^ cell[:, j].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out


class Codebook:
    """Entries of one part position and, per grid cell, those that can be nearest."""

    def __init__(self, entries: list[tuple[int, ...]]):
        small = all(abs(x) < SMALL for e in entries for x in e)
        self.book = np.array(entries, np.int64 if small else object)
        spread = sorted(max(c) - min(c) for c in zip(*entries))
        self.side = max(1, int(spread[len(spread) // 2] * SIDE))
        self.evaluated = 0
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[int, int] = {}
        self.cells = np.zeros((0, self.book.shape[1]), np.int64)
        self.masks = np.zeros((0, len(self.book)), bool)

    def near(self, cell: np.ndarray) -> np.ndarray:
        """Which entries can be nearest to a point of each cell.  An entry is
        dominated if its least distance to the box is above some entry's
        greatest, or if some entry is nearer all over the box: the difference
        of two squared distances is linear, so its greatest value lies at the
        corner that every component picks for itself."""
        low = cell[:, None, :] * self.side
        high = low + (self.side - 1)
        under, over = low - self.book, self.book - high
        least = np.maximum(np.maximum(under, over), 0)
        most = np.maximum(-under, -over)                     # to the farther face
        near = (least * least).sum(2) <= (most * most).sum(2).min(1)[:, None]
        norm = (self.book * self.book).sum(1)
        for f, entry in enumerate(self.book):
            gap = 2 * (self.book - entry)                    # |x - entry|^2 - |x - e|^2 = x . gap + norms
            near &= np.maximum(low * gap, high * gap).sum(2) + (norm[f] - norm) >= 0
        return near

    def _remembered(self, cell: np.ndarray) -> np.ndarray:
        """``near`` of each cell, computed once per cell and worker."""
        keys, first, at = np.unique(_cell_hash(cell), return_index=True, return_inverse=True)
        if len(self.memo) + len(keys) > CELL_MEMO:
            self._forget()
        places = np.array([self.memo.get(key, -1) for key in keys.tolist()])
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = np.arange(len(new)) + len(self.memo)
            self.memo.update(zip(keys[new].tolist(), places[new].tolist()))
            own = cell[first[new]]
            if len(self.memo) > len(self.cells):             # room for twice as many
                more = 2 * len(self.memo) - len(self.cells)
                self.cells = np.vstack([self.cells, np.zeros((more, own.shape[1]), np.int64)])
                self.masks = np.vstack([self.masks, np.zeros((more, len(self.book)), bool)])
            self.cells[places[new]], self.masks[places[new]] = own, self.near(own)
        masks = self.masks[places[at]]
        other = np.flatnonzero((self.cells[places[at]] != cell).any(1))
        if len(other):                                       # another cell of the same hash
            masks[other] = self.near(cell[other])
        return masks

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lowest) and squared distance.
        Cells of very large components are bounded alike but not remembered."""
        cell = x // self.side
        small = x.dtype != object and self.book.dtype != object
        row, entry = np.nonzero((self._remembered if small else self.near)(cell))
        self.evaluated += len(row)
        gap = x[row] - self.book[entry]
        dist = (gap * gap).sum(1)
        start = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(dist, start)
        hit = np.flatnonzero(dist == least[row])             # the lowest entry of a row comes first
        return entry[hit[np.searchsorted(row[hit], np.arange(len(x)))]], least


def _blocks(batch, column: int, dim: int):
    """Row ranges of a batch and their vectors, cut into parts."""
    for a in range(0, len(batch), BLOCK_ROWS):
        x = _matrix(batch.column(column).slice(a, BLOCK_ROWS), dim)
        yield a, x.reshape(len(x), PARTS, -1).transpose(1, 0, 2)


def _refined(rows: DataFrame, dim: int, books: list) -> list:
    """One round: the mean (rounded down) of every entry's parts; an entry
    without parts stays."""

    def step(batches):
        search = [Codebook(b) for b in books]
        count = np.zeros((PARTS, len(books[0])), np.int64)
        total = np.zeros((PARTS, len(books[0]), dim // PARTS), object)
        for batch in batches:
            for _, parts in _blocks(batch, 0, dim):
                for p, x in enumerate(parts):
                    best, _ = search[p].assign(x)
                    n = np.bincount(best, minlength=len(books[p]))
                    order = np.argsort(best, kind="stable")
                    used = np.flatnonzero(n)
                    total[p, used] += np.add.reduceat(x[order], (np.cumsum(n) - n)[used], axis=0)
                    count[p] += n
        p, e, c = (i.ravel() for i in np.indices(total.shape))
        yield to_batch({"part": p, "entry": e, "place": c, "n": count[p, e], "total": list(map(str, total.ravel()))}, schema)

    shape = "part int, entry int, place int, n long, total string"
    schema = _arrow_schema(rows.sparkSession, shape)
    sums = (rows.select("v").mapInArrow(step, shape).groupBy("part", "entry", "place")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    out = [[list(e) for e in b] for b in books]
    for r in sums.filter("n > 0").collect():                 # dim * ENTRIES rows
        out[r.part][r.entry][r.place] = int(r.total) // r.n
    return [[tuple(e) for e in b] for b in out]


def digest(books: list) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def compress(vectors: DataFrame) -> tuple[DataFrame, list]:
    """Codes of ``vectors`` (vec_id, label, v of whole numbers) and the final
    codebooks.  The frame: vec_id, label, code (two hex digits a part), error
    (squared distance to the coded vector; null beyond 64 bits).

    Every codebook starts as the parts of the 16 smallest vec_ids (nulls last,
    equal ids by their vectors; fewer rows, fewer entries).  Shorter vectors
    are padded with zeros to the longest, that one to a multiple of 8.  Equal
    rows are rows of their own; an empty table gives no rows."""
    spark = vectors.sparkSession
    rows = settle(vectors.select("vec_id", "label", "v"), "vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    out = "vec_id long, label {}, code string, error long".format(rows.schema["label"].dataType.simpleString())
    if longest is None:
        return spark.createDataFrame([], out), []
    dim = max(PARTS, -(-longest // PARTS) * PARTS)
    width = dim // PARTS
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).select("v").collect()
    start = [[int(x) for x in r[0]] + [0] * (dim - len(r[0])) for r in first]
    books = [[tuple(v[p * width:(p + 1) * width]) for v in start] for p in range(PARTS)]
    for _ in range(ROUNDS):
        books = _refined(rows, dim, books)

    def code(batches):
        search = [Codebook(b) for b in books]
        for batch in batches:
            codes, errors = [], []
            for _, parts in _blocks(batch, 2, dim):
                found = [search[p].assign(x) for p, x in enumerate(parts)]
                codes += ["".join(map("{:02x}".format, r)) for r in zip(*(best.tolist() for best, _ in found))]
                errors += [e if e < 1 << 63 else None for e in map(sum, zip(*(d.tolist() for _, d in found)))]
            yield to_batch({"vec_id": batch.column(0), "label": batch.column(1), "code": codes, "error": errors}, schema)

    schema = _arrow_schema(spark, out)
    return settle(rows.mapInArrow(code, out), "codes"), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error: the errors summed over its label's rows
    (nulls are one label).  The sums are settled before they are joined, so a
    label of many rows is split like any other."""
    sums = settle(coded.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
