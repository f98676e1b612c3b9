"""SimHash near-duplicates by deletion-variant signatures (operator 1).

Two 64-bit fingerprints at distance <= 4 cut into three segments have one
segment that differs in at most one bit.  Every distinct fingerprint is indexed
under all its one-wildcard segment variants (64 of them: the segment with one
bit blanked); equal variants meet by an equality shuffle and the full distance
is verified there.  Exact copies meet only as one fingerprint."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import _arrow_schema, components, map_arrow, settle, to_batch

SHINGLE = 4
DISTANCE = 4
SEED = 42
HEAVY = 4096
_SPACE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a whole text, as an unsigned 64-bit number (no words: 0)."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    stop = ends[min(shingle, len(words)) - 1:].tolist()
    start = [0, *(ends[:n - 1] + 1).tolist()]
    hash64 = xxhash.xxh64_intdigest
    count = np.zeros(64, np.int64)
    for a in range(0, n, _SPACE):
        h = np.array([hash64(joined[i:j], seed) for i, j in zip(start[a:a + _SPACE], stop[a:a + _SPACE])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * count > n).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a long) of every row; null text as empty."""
    def step(batch):
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
        return {"doc_id": batch.column(0), "text_hash": batch.column(2), "fp": pa.array(fps.view(np.int64))}
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_arrow(rows, step, "doc_id long, text_hash long, fp long")


def segments(distance: int, bits: int = 64) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one has at most one
    differing bit: more than half the distance, rounded down."""
    n = distance // 2 + 1
    cuts = [bits * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(fp, distance: int):
    """Array of 64 keys: wildcard position, then the segment without that bit."""
    keys = []
    for first, width in segments(distance):
        for bit in range(width):
            mask = ((1 << width) - 1) & ~(1 << bit)
            part = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(mask).cast("long"))
            keys.append(part.bitwiseOR(F.lit((first + bit) << 40).cast("long")))
    return F.array(*keys)


def _heavy_keys(classes: DataFrame, distance: int, limit: int) -> DataFrame:
    """Variant keys that more than about ``limit`` fingerprints share, with the
    number of blocks to deal each over.  A key holds the fingerprints of two
    segment values, so only values with over limit / 2 can make one heavy."""
    parts = segments(distance)
    seg = F.array(*[F.struct(F.lit(k).alias("s"),
                             F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1).cast("long")).alias("v"))
                    for k, (a, w) in enumerate(parts)])
    counts = (classes.select(F.explode(seg).alias("x")).groupBy("x.s", "x.v").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > limit // 2))
    wild = F.array(*[F.array(*[F.col("v").bitwiseAND(F.lit(((1 << w) - 1) & ~(1 << b)).cast("long"))
                               .bitwiseOR(F.lit((a + b) << 40).cast("long")) for b in range(w)])
                     for a, w in parts])
    return (counts.select(F.explode(F.element_at(wild, F.col("s") + 1)).alias("key"), "n")
            .groupBy("key").agg(F.ceil(F.sum("n") / F.lit(limit // 2)).cast("int").alias("blocks")))


def _run_links(fps: np.ndarray, distance: int):
    """Links that join the fingerprints of one run: a search that takes each
    member once and links it to all unreached ones in reach."""
    us, vs = [], []
    rest = fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                hit = rest[near]
                us.append(np.full(len(hit), x))
                vs.append(hit)
                queue.extend(hit)
                rest = rest[~near]
    return us, vs


def _batch_links(key: np.ndarray, fp: np.ndarray, distance: int, dense: int = 24):
    """Verified links of sorted (key, fp) rows whose runs are complete."""
    us, vs = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
    sizes = np.diff(np.append(starts, len(key)))
    for a, n in zip(starts[sizes > dense].tolist(), sizes[sizes > dense].tolist()):
        u, v = _run_links(np.unique(fp[a:a + n]), distance)
        us += u
        vs += v
    small = np.repeat(sizes <= dense, sizes)
    k, f = np.repeat(np.arange(len(sizes)), sizes)[small], fp[small]
    for lag in range(1, dense):
        if len(k) <= lag:
            break
        at = np.flatnonzero(k[lag:] == k[:-lag])
        if not len(at):
            break
        at = at[np.bitwise_count(f[at] ^ f[at + lag]) <= distance]
        us.append(f[at])
        vs.append(f[at + lag])
    u, v = np.concatenate(us), np.concatenate(vs)
    both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
    return both[both[:, 0] != both[:, 1]]


def links(classes: DataFrame, distance: int = DISTANCE, heavy: int = HEAVY) -> DataFrame:
    """Links u, v (longs) between distinct fingerprints ``fp`` that connect the
    same components as all pairs within the distance.

    A variant shared by over ``heavy`` fingerprints is dealt over blocks: each
    member goes to every pair of blocks that holds its own block, so all pairs
    still meet and no task gets the whole run."""
    keyed = classes.select("fp", F.explode(_variants(F.col("fp"), distance)).alias("key"))
    hot = settle(_heavy_keys(classes, distance, heavy), "heavy")
    n_hot = hot.count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= 50_000 else hot
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        keyed = (keyed.join(hot, "key", "left").withColumn("own", F.coalesce(own, F.lit(0)))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
                 .selectExpr("fp", "key", "least(own, other) * 100000L + greatest(own, other) AS part"))
    else:
        keyed = keyed.withColumn("part", F.lit(0).cast("long"))
    schema = "u long, v long"
    target = _arrow_schema(classes.sparkSession, schema)

    def run(batches):
        held = None
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            held = now if held is None else np.concatenate([held, now])
            cut = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1))
            if not len(cut):
                continue
            done, held = held[:cut[-1] + 1], held[cut[-1] + 1:]
            yield emit(done)
        if held is not None and len(held):
            yield emit(held)

    def emit(rows):
        found = _batch_links(rows[:, :2], np.ascontiguousarray(rows[:, 2]).view(np.uint64), distance)
        return to_batch({"u": pa.array(found[:, 0].view(np.int64)), "v": pa.array(found[:, 1].view(np.int64))}, target)

    dealt = keyed.select("key", "part", "fp").repartition("key", "part").sortWithinPartitions("key", "part", "fp")
    return dealt.mapInArrow(run, schema).distinct()


def _least_of_component(docs: DataFrame, least, shingle: int, distance: int) -> DataFrame:
    """doc_id, text_hash, fp and the smallest ``least`` of its component (``named``) for every row."""
    rows = settle(fingerprints(docs, shingle), "fingerprints")
    classes = settle(rows.groupBy("fp").agg(F.min(least).alias("least")), "classes")
    roots = components(links(classes, distance)).withColumnsRenamed({"node": "fp"})
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("named"))
    of = rooted.select("fp", "root").join(named, "root").select("fp", "named")
    return rows.join(of, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links of at
    most ``distance`` bits) for every row.  Rows without a doc_id are kept and
    never name a component; a component of only such rows has a null id."""
    rows = _least_of_component(docs, F.col("doc_id"), shingle, distance)
    return rows.select("doc_id", "fp", F.col("named").alias("component_id"))


def first_of_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, text_hash, first for every row: whether it is the row of its
    component with the smallest doc_id (null ids last), then text hash."""
    own = F.struct(F.col("doc_id").isNull().alias("missing"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")
    rows = _least_of_component(docs, own, shingle, distance)
    return rows.select("doc_id", "text_hash", (F.col("named") == own).alias("first"))
