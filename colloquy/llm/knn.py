"""Exact top-k search by a Voronoi join (operator 5).

Data and queries are grouped by their nearest pivot; a group's rows are dealt
over cells of bounded size.  Every cell has a summary (centre, radius, rows).
A query takes the best scores of its own group as a first threshold; a cell is
needed only if centre . q + radius * |q| can reach it.  Only needed (query,
cell) pairs are replicated, and each cell is solved locally, its best k per
query merged afterwards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import _arrow_schema, map_arrow, settle, to_batch

PIVOTS = 64
CELL_ROWS = 2048
QUERY_ROWS = 512
WHOLE = float(1 << 52)     # doubles from here on are whole (and FLOOR gives a long)


def quantised(vectors: DataFrame, factor: float = 64.0) -> DataFrame:
    """vec_id, v = floor(factor * x) per component, x as double.  Vectors that
    are null or hold null or non-finite components are left out; an empty one
    is the zero vector."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    usable = F.col("embedding").isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return vectors.filter(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.transform(x, lambda e: F.when(F.abs(e) < WHOLE, F.floor(e * factor).cast("double"))
                              .otherwise(e * factor)).alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, short rows padded with zeros."""
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(at)
    out = np.zeros((len(column), dim))
    where = np.repeat(np.arange(len(column)), sizes)
    out[where, np.arange(len(flat[at[0]:at[-1]])) - np.repeat(at[:-1] - at[0], sizes)] = flat[at[0]:at[-1]]
    return out


def _near(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.argmin((pivots ** 2).sum(1) - 2 * (x @ pivots.T), axis=1)


def search(vectors: DataFrame, is_query, k: int = 20, n_pivots: int = PIVOTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every row
    where ``is_query`` holds against all rows but itself (by vec_id), ties to
    the smaller vec_id.  Vectors (vec_id, v) of whole numbers, so that scores
    are exact; shorter vectors count as padded with zeros; rows without a
    vec_id are candidates that rank after all others of the same score and
    never queries; a repeated vec_id is listed once for each of its rows.
    Large components are kept in 64 bits; a score beyond 64 bits raises."""
    spark = vectors.sparkSession
    rows = settle(vectors.select("vec_id", "v", F.coalesce(is_query & F.col("vec_id").isNotNull(), F.lit(False)).alias("q")), "vectors")
    out = "query_id long, rank int, vec_id long, score long"
    first = rows.agg(F.max(F.size("v")), F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    dim, total, top = first[0] or 0, first[1], first[2] or 0.0
    if top >= 2.0 ** 63:
        raise ValueError("components of 2^63 and more have no 64-bit scores")
    stored = "<i4" if top < 2.0 ** 31 else "<i8"
    kind = np.float64 if dim * top * top < 2.0 ** 53 else np.int64      # of which every score is exact
    if not total or not dim:
        return spark.createDataFrame([], out) if not total else _zero_scores(rows, k)
    chosen = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(n_pivots).collect()
    pivots = np.zeros((len(chosen), dim))
    for i, r in enumerate(chosen):
        pivots[i, :len(r[0])] = r[0]

    def assign(batch):
        x = _matrix(batch.column(1), dim)
        group = _near(x, pivots)
        return {"vec_id": batch.column(0), "x": [r.tobytes() for r in x.astype(stored)], "q": batch.column(2), "g": group}

    grouped = settle(map_arrow(rows, assign, "vec_id long, x binary, q boolean, g int"), "groups")
    sizes = {r[0]: r[1] for r in grouped.groupBy("g").count().collect()}     # one row a pivot
    parts = np.array([max(1, -(-sizes.get(g, 0) // cell_rows)) for g in range(len(pivots))])
    n_parts = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("g") + 1)
    cells = grouped.withColumn("part", F.pmod(F.xxhash64("vec_id", "x"), n_parts).cast("int"))

    def decode(col) -> np.ndarray:
        return np.frombuffer(b"".join(col.to_pylist()), stored).reshape(-1, dim).astype(float)

    def summarise(batch):
        x, g, p = decode(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        key, at = np.unique(np.stack([g, p], 1), axis=0, return_inverse=True)
        reach = np.zeros(len(key))
        np.maximum.at(reach, at.ravel(), np.linalg.norm(x - pivots[g], axis=1))
        return {"g": key[:, 0], "part": key[:, 1], "radius": reach}

    summary = (map_arrow(cells.select("x", "g", "part"), summarise, "g int, part int, radius double")
               .groupBy("g", "part").agg(F.max("radius").alias("radius")))

    # blocks: rows of one cell (or query group) as one matrix
    def block(rows_, keys):
        return rows_.groupBy(*keys).agg(F.collect_list(F.struct("vec_id", "x")).alias("rows"))

    data = settle(block(cells, ["g", "part"]).join(summary, ["g", "part"]), "cells")
    asked_of = {r[0]: r[1] for r in grouped.filter("q").groupBy("g").count().collect()}
    q_parts = F.pmod(F.xxhash64("vec_id"), F.element_at(F.array(
        *[F.lit(max(1, -(-asked_of.get(g, 0) // QUERY_ROWS))) for g in range(len(pivots))]), F.col("g") + 1))
    queries = settle(block(grouped.filter("q").dropDuplicates(["vec_id", "x"])
                           .withColumn("part", q_parts.cast("int")), ["g", "part"])
                     .withColumnsRenamed({"g": "qg", "part": "qpart", "rows": "queries"}), "queries")

    found = _arrow_schema(spark, "query_id long, vec_id long, score long")
    last = np.iinfo(np.int64).max

    def unpack(cell):
        ids = np.array([last if r["vec_id"] is None else r["vec_id"] for r in cell], np.int64)
        x = np.frombuffer(b"".join([r["x"] for r in cell]), stored).reshape(-1, dim).astype(kind)
        return ids, x

    def products(qi, q, ci, c):
        if kind is np.int64 and len(q):
            size = np.abs(q.astype(float) @ c.T.astype(float))
            if np.where(qi[:, None] == ci[None, :], 0, size).max(initial=0) >= 2.0 ** 62.99:
                raise OverflowError("a score does not fit 64 bits")
        return q @ c.T

    def best_of(qi, ci, scores):
        """The k best (score, smaller id) per query row, as flat arrays."""
        low = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        scores = np.where(qi[:, None] == ci[None, :], low, scores)
        order = np.argsort(ci, kind="stable")
        n = min(k, len(ci))
        top = np.argsort(-scores[:, order], axis=1, kind="stable")[:, :n] if len(ci) <= 4 * k else None
        if top is None:
            s = scores[:, order]
            edge = -np.partition(-s, n - 1, axis=1)[:, n - 1:n]
            top = np.empty((len(qi), n), np.int64)
            for i in range(len(qi)):
                at = np.flatnonzero(s[i] >= edge[i])
                top[i] = at[np.argsort(-s[i][at], kind="stable")[:n]]
        who = order[top]
        got = np.take_along_axis(scores, who, 1)
        ok = got > low
        return np.repeat(qi, n).reshape(-1, n)[ok], ci[who][ok], got[ok].astype(np.int64)

    def solve(iterator):
        for batch in iterator:
            for r in batch.to_pylist():
                qi, q = unpack(r["queries"])
                ci, c = unpack(r["rows"])
                if r.get("need") is not None:
                    keep = np.isin(qi, np.array(r["need"], np.int64))
                    qi, q = qi[keep], q[keep]
                a, b, s = best_of(qi, ci, products(qi, q, ci, c))
                ids = pa.array(b, mask=b == last)
                yield to_batch({"query_id": a, "vec_id": ids, "score": s}, found)

    scored = "query_id long, vec_id long, score long"
    # first threshold: the k-th best of the query's own group
    home = settle(queries.join(data.select(F.col("g").alias("qg"), "rows"), "qg").select("queries", "rows")
                  .mapInArrow(solve, scored), "home")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = home.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    bar = best.filter(F.col("rank") == k).select(F.col("query_id"), F.col("score").alias("bar"))
    asked = grouped.filter("q").select(F.col("vec_id").alias("query_id"), "x", F.col("g").alias("qg"),
                                       q_parts.cast("int").alias("qpart")).join(bar, "query_id", "left")
    # cells that can reach the bar: centre . q + radius |q| >= bar
    reach = data.groupBy("g").agg(F.max("radius").alias("radius"))
    radius = np.full(len(pivots), -1.0)
    for r in reach.collect():                                                # one row a pivot
        radius[r[0]] = r[1]

    def needed(batch):
        x, qg = decode(batch.column(1)), batch.column(2).to_numpy()
        bar_ = batch.column(4).to_numpy(zero_copy_only=False).astype(float)
        size = np.linalg.norm(x, axis=1)[:, None]
        bound = x @ pivots.T + size * radius                                 # rounding: far under 1e-9 of its terms
        bound += 1e-6 + 1e-9 * size * (np.linalg.norm(pivots, axis=1) + np.maximum(radius, 0))
        want = (radius >= 0) & (np.isnan(bar_)[:, None] | (bound >= bar_[:, None]))
        want[np.arange(len(x)), qg] = False                                  # the own group is done
        i, g = np.nonzero(want)
        return {"query_id": batch.column(0).take(pa.array(i)), "g": g, "qg": qg[i],
                "qpart": batch.column(3).to_numpy()[i]}

    pairs = (map_arrow(asked.select("query_id", "x", "qg", "qpart", "bar"), needed, "query_id long, g int, qg int, qpart int")
             .groupBy("qg", "qpart", "g").agg(F.collect_set("query_id").alias("need")))
    other = (pairs.join(queries, ["qg", "qpart"]).join(data.select("g", "rows"), "g").select("queries", "rows", "need")
             .mapInArrow(solve, scored))
    merged = best.drop("rank").unionByName(other)
    final = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return final.select("query_id", "rank", "vec_id", "score")


def _zero_scores(rows: DataFrame, k: int) -> DataFrame:
    """All vectors are empty: every score is 0, the smallest other ids win."""
    ids = rows.select("vec_id").orderBy(F.asc_nulls_last("vec_id")).limit(k + 1)
    pairs = rows.filter("q").select(F.col("vec_id").alias("query_id")).join(F.broadcast(ids), ~F.col("query_id").eqNullSafe(F.col("vec_id")))
    order = Window.partitionBy("query_id").orderBy(F.asc_nulls_last("vec_id"))
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.lit(0).cast("long").alias("score")))
