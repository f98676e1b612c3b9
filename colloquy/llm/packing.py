"""Bulk-synchronous best-fit packing of pieces into sequences (operator 4).

Lengths are whole numbers up to the capacity, so documents sorted by length
fall into at most ``capacity`` runs of equal length, and so do gaps.  The
supersteps work on runs: take the longest unplaced run, sweep to the successor
gap run (smallest gap that fits), let documents and gaps meet by rank (document
k of the run takes gap k), update the gaps, repeat; documents no gap can hold
open new sequences.  A superstep places a whole rank range at once, so the
number of supersteps depends on the capacity and never on the row count.  The
ranks of the documents and the lookup of their places are distributed."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import ddl, map_arrow, settle

RANK_BUCKETS = 256


def best_fit(runs: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length -> documents) to placements (length, first rank, documents,
    first sequence, offset): document ``first + i`` of its run goes to sequence
    ``first sequence + i`` at ``offset``.  Ranks and sequences count from 0."""
    gaps: dict[int, deque] = {}
    sizes: list[int] = []
    opened = 0
    out = []

    def free(size: int, first: int, n: int, front: bool = False) -> None:
        if size <= 0 or n <= 0:
            return
        if size not in gaps:
            gaps[size] = deque()
            insort(sizes, size)
        (gaps[size].appendleft if front else gaps[size].append)((first, n))

    for length in sorted(runs, reverse=True):
        left, rank = runs[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                size = sizes[at]
                first, n = gaps[size].popleft()
                if not gaps[size]:
                    del gaps[size]
                    sizes.pop(at)
            else:
                size, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            take = min(left, n)
            out.append((length, rank, take, first, capacity - size))
            free(size, first + take, n - take, front=True)
            free(size - length, first, take)
            left, rank = left - take, rank + take
    return out


def pack(pieces: DataFrame, capacity: int, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces (doc_id, piece, start, length,
    ids_crc32, ...).  Every row is placed once, repeated rows each on their
    own; rows without a length in 1..capacity raise an error.

    A piece's rank in its length is the count of the smaller hash buckets of
    that length plus its place in its own bucket: a length that a third of all
    rows share is ranked by ``buckets`` tasks, and only (length, bucket) counts
    meet.  The driver gets at most ``capacity`` run lengths."""
    key = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    rows = settle(pieces.withColumn("_b", key), "pieces")
    counts = rows.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    runs = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    if any(n is None or not 0 < n <= capacity for n in runs):
        raise ValueError(f"piece lengths must be 1..{capacity}")
    plan = best_fit(runs, capacity)
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    own = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (rows.withColumn("_r", F.row_number().over(own) - 1).join(starts, ["length", "_b"])
              .withColumn("_r", (F.col("_r") + F.col("_s")).cast("long")))
    table = np.array(sorted(plan) or [(0, 0, 0, 0, 0)], dtype=np.int64)
    keys = (table[:, 0] << 48) + table[:, 1]

    def step(batch):
        cols = {n: batch.column(i) for i, n in enumerate(names)}
        rank = cols["_r"].to_numpy()
        at = np.searchsorted(keys, (cols["length"].to_numpy() << 48) + rank, "right") - 1
        hit = table[at]
        return {**cols, "sequence_id": hit[:, 3] + rank - hit[:, 1], "offset": hit[:, 4]}

    names = [*pieces.columns, "_r"]
    return map_arrow(ranked.select(*names), step, ddl(pieces) + ", sequence_id long, offset long")
