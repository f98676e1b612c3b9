"""Exact duplicate byte strings by suffix arrays of Lyndon groups (operator 7).

A window is a string of ``length`` bytes.  Every window picks an anchor gram
(see ``anchors``), so equal windows meet under equal grams at equal places, and
only grams that occur twice matter.  What an anchor owns is its context.
Identical contexts collapse to one string with its first place; contexts that
differ are cut into two blocks of windows, and the blocks that share the bytes
common to all windows of the block form a group.  A group's windows are decided
by the suffix array of its strings."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.anchors import GRAM, RangeHash, anchor_runs, cover_hash
from colloquy.llm.common import BROADCAST_IDS, _arrow_schema, map_arrow, settle, to_batch

LENGTH = 100
CHUNK_BYTES = 30_000
BITMAP_BITS = 1 << 26      # fixed size of the broadcast filter; a full one lets everything pass
GROUP_STRINGS = 1024       # larger groups are decided window by window
BROADCAST_BYTES = 32 << 20


def suffix_order(strings: list[bytes]) -> list[tuple[int, int]]:
    """All suffixes (string, position) in lexicographic order, ends of strings
    smallest, equal suffixes by string.

    Grouping construction: a suffix's group is its Lyndon prefix, the word up
    to its next smaller suffix, found from right to left by joining words.
    Slots are given to the groups in descending order.  Then the order is
    emitted in one pass: each suffix that is taken sends the suffixes whose
    next smaller suffix it is, reached over previous-smaller pointers, to the
    front of their groups.  Nothing is renamed or sorted again."""
    following: list[list[int]] = []
    previous: list[list[int]] = []
    members: dict[bytes, int] = {}
    for s in strings:
        n = len(s)
        after, before = [n] * n, [-1] * n
        for i in range(n - 1, -1, -1):
            j = i + 1
            while j < n and s[i:j] < s[j:after[j]]:
                before[j] = i
                j = after[j]
            after[i] = j
            word = s[i:j]
            members[word] = members.get(word, 0) + 1
        following.append(after)
        previous.append(before)
    front: dict[bytes, int] = {}
    total = slot = sum(members.values())
    for word in sorted(members, reverse=True):
        slot -= members[word]
        front[word] = slot
    order: list = [None] * total

    def send(k: int, p: int) -> None:
        s, after, before, i = strings[k], following[k], previous[k], p - 1
        while i >= 0 and after[i] == p:
            word = s[i:p]
            at = front[word]
            order[at] = (k, i)
            front[word] = at + 1
            i = before[i]

    for k, s in enumerate(strings):
        send(k, len(s))
    for at in range(total):
        send(*order[at])
    return order


def duplicate_windows(strings: list[bytes], places: list[tuple], length: int) -> list[list[int]]:
    """For each string, which of its windows also start earlier in another one.
    ``places``: where each string starts, as a tuple whose last number grows
    with the position.  Of equal strings the first stands for all in the order;
    every window of the others starts earlier in it."""
    earliest: dict[bytes, int] = {}
    for k, s in enumerate(strings):
        if s not in earliest or places[k] < places[earliest[s]]:
            earliest[s] = k
    if len(earliest) < len(strings):
        own = list(earliest.values())
        found = duplicate_windows([strings[k] for k in own], [places[k] for k in own], length)
        by = dict(zip(own, found))
        return [by[k] if k in by else list(range(len(s) - length + 1)) for k, s in enumerate(strings)]
    out: list[list[int]] = [[] for _ in strings]
    if len(strings) < 2:
        return out
    run: list[tuple[int, int]] = []

    def close():
        if len(run) > 1:
            at = [(*places[k][:-1], places[k][-1] + i) for k, i in run]
            first = min(at)
            for (k, i), where in zip(run, at):
                if where > first:
                    out[k].append(i)

    last = None
    for k, i in suffix_order(strings):
        if i + length <= len(strings[k]):
            window = strings[k][i:i + length]
            if window != last:
                close()
                run, last = [], window
            run.append((k, i))
    close()
    return out


class _Chunks:
    """Documents of a batch laid end to end, about CHUNK_BYTES at a time."""

    def __init__(self, texts: list[str | None], length: int, gram: int):
        self.raw = [(t or "").encode("utf-8") for t in texts]
        self.length, self.gram = length, gram

    def __iter__(self):
        first, size = 0, 0
        for n, raw in enumerate(self.raw):
            size += len(raw)
            if size >= CHUNK_BYTES or n == len(self.raw) - 1:
                own = self.raw[first:n + 1]
                data = np.frombuffer(b"".join(own), np.uint8)
                ends = np.cumsum([len(r) for r in own])
                ranges, doc, gram, p, lo, hi = anchor_runs(data, ends, self.length, self.gram)
                if len(doc):
                    cover = cover_hash(ranges, p, lo, hi, self.length)
                    start = (ends - np.array([len(r) for r in own]))[doc]
                    yield data, doc + first, gram.view(np.int64), cover.view(np.int64), p - lo, lo, hi, start
                first, size = n + 1, 0


def _bitmap(spark, grams: DataFrame) -> np.ndarray:
    """One bit per hashed gram, as bytes; at most BITMAP_BITS bits."""
    x = F.pmod("h", F.lit(BITMAP_BITS).cast("long")) + 1      # Spark numbers bits from 1
    rows = (grams.select(F.bitmap_bucket_number(x).alias("b"), F.bitmap_bit_position(x).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect())
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in rows:
        at = (r.b - 1) * 4096
        bits = np.frombuffer(bytes(r.bits), np.uint8)
        out[at:at + len(bits)] = bits
    return out


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    x = np.mod(h, BITMAP_BITS)
    return (bits[x >> 3] >> (x & 7).astype(np.uint8)) & 1 != 0


OCCURRENCES = "h long, c long, doc_id long, th binary, lo int, off int, n int, ctx binary"


def occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors whose gram occurs more than once (and a few others): gram and
    context hashes, document, first window, the anchor's place in the context,
    windows, and the context itself where contexts of a gram differ."""
    spark = docs.sparkSession

    def seen(batch):
        h, c = [], []
        for _, _, gram_, cover, *_ in _Chunks(batch.column(0).to_pylist(), length, gram):
            h.append(gram_)
            c.append(cover)
        return {"h": np.concatenate(h), "c": np.concatenate(c)} if h else None

    repeated = settle(map_arrow(docs.select("text"), seen, "h long, c long").groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("c1"), F.max("c").alias("c2"))
        .filter("n > 1").selectExpr("h", "c1 <> c2 AS differ"), "grams")
    wanted = spark.sparkContext.broadcast((_bitmap(spark, repeated), _bitmap(spark, repeated.filter("differ"))))

    def step(batch):
        some, differ = wanted.value
        ids, th = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        cols: dict[str, list] = {k: [] for k in ("h", "c", "doc_id", "th", "lo", "off", "n", "ctx")}
        given = set()
        for data, doc, h, c, off, lo, hi, start in _Chunks(batch.column(2).to_pylist(), length, gram):
            at = np.flatnonzero(_has(some, h))
            if not len(at):
                continue
            doc, h, c, off, lo, hi, start = (x[at] for x in (doc, h, c, off, lo, hi, start))
            text = data.tobytes()
            ctx = []
            for other, a, b, *pair in zip(_has(differ, h).tolist(), lo.tolist(), hi.tolist(), h.tolist(), c.tolist()):
                pair = tuple(pair)
                if other and pair not in given:
                    given.add(pair)
                    ctx.append(text[a:b + length])
                else:
                    ctx.append(None)
            cols["h"] += h.tolist()
            cols["c"] += c.tolist()
            cols["doc_id"] += [ids[d] for d in doc.tolist()]
            cols["th"] += [th[d] for d in doc.tolist()]
            cols["lo"] += (lo - start).tolist()
            cols["off"] += off.tolist()
            cols["n"] += (hi - lo + 1).tolist()
            cols["ctx"] += ctx
        return cols if cols["h"] else None

    return map_arrow(docs.select("doc_id", "th", "text"), step, OCCURRENCES)


def _blocks(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts cut by the distance of a window's start from the anchor into two
    blocks; ``core``: hash of the bytes that all windows of the whole block
    share.  s: the bytes of the context's own windows in the block."""
    span = length - gram + 1
    half = -(-span // 2)

    def step(batch):
        ctx = batch.column(2).to_pylist()
        sizes = np.array([len(x) for x in ctx])
        ranges = RangeHash(np.frombuffer(b"".join(ctx), np.uint8))
        at = np.cumsum(sizes) - sizes
        off, lo = batch.column(3).to_numpy().astype(np.int64), batch.column(6).to_numpy().astype(np.int64)
        out: dict[str, list] = {k: [] for k in ("rows", "block", "core", "at", "shift", "s")}
        for block in range(2):
            # windows start at off - d for distances d of the block; the core
            # runs from the nearest start to the farthest end
            far, near = off - min(span - 1, block * half + half - 1), off - block * half
            a, b = np.maximum(far, 0), np.minimum(near, sizes - length)
            ok = np.flatnonzero(a <= b)
            out["rows"].append(ok)
            out["block"].append(np.full(len(ok), block))
            out["core"].append(ranges.of((at + near)[ok], (at + far)[ok] + length).view(np.int64))
            out["at"].append((lo + a)[ok])
            out["shift"].append(a[ok])
            out["s"] += [ctx[k][i:j] for k, i, j in zip(ok.tolist(), a[ok].tolist(), (b[ok] + length).tolist())]
        rows = pa.array(np.concatenate(out["rows"]))
        return {"h": batch.column(0).take(rows), "c": batch.column(1).take(rows), "doc_id": batch.column(4).take(rows),
                "th": batch.column(5).take(rows), "s": out["s"],
                **{k: np.concatenate(out[k]) for k in ("block", "core", "at", "shift")}} if len(rows) else None

    return map_arrow(contexts.select("h", "c", "ctx", "off", "doc_id", "th", "lo"), step,
                     "h long, c long, block int, core long, doc_id long, th binary, at int, shift int, s binary")


def _verdicts(contexts: DataFrame, length: int, gram: int, limit: int) -> DataFrame:
    """h, c, dups (window numbers of the context that start earlier elsewhere)
    for contexts that differ from others of their gram."""
    key = ["h", "block", "core"]
    counts = settle(_blocks(contexts, length, gram).groupBy(*key).agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "cores")
    shared = settle(_blocks(contexts, length, gram).join(counts, key), "shared")
    member = F.struct("c", "doc_id", "th", "at", "shift", "s")
    groups = shared.filter(F.col("k") <= limit).groupBy(*key).agg(F.collect_list(member).alias("members"))
    target = _arrow_schema(contexts.sparkSession, "h long, c long, dups array<int>")

    def solve(batches):
        for batch in batches:
            h_, c_, d_ = [], [], []
            for h, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = -(1 << 63) - 1
                places = [(low if m["doc_id"] is None else m["doc_id"], m["th"], m["at"]) for m in members]
                found = duplicate_windows([m["s"] for m in members], places, length)
                for m, windows in zip(members, found):
                    if windows:
                        h_.append(h)
                        c_.append(m["c"])
                        d_.append([m["shift"] + w for w in windows])
            yield to_batch({"h": h_, "c": c_, "dups": d_}, target)

    light = groups.select("h", "members").mapInArrow(solve, "h long, c long, dups array<int>")
    if not counts.filter(F.col("k") > limit).limit(1).count():
        return light.groupBy("h", "c").agg(F.flatten(F.collect_list("dups")).alias("dups"))
    # a group with more strings than one task should order: each window meets
    # its equals by itself
    wide = (shared.filter(F.col("k") > limit)
            .withColumn("w", F.explode(F.sequence(F.lit(0), F.octet_length("s") - length)))
            .selectExpr("h", "c", "block", "core", "doc_id", "th", "at + w AS at", "shift + w AS w",
                        f"substring(s, w + 1, {length}) AS s"))
    firsts = wide.groupBy(*key, "s").agg(F.min(F.struct("doc_id", "th", "at")).alias("first"), F.count(F.lit(1)).alias("m"))
    heavy = (wide.join(firsts.filter("m > 1"), [*key, "s"]).filter(F.struct("doc_id", "th", "at") > F.col("first"))
             .groupBy("h", "c").agg(F.collect_list("w").alias("dups")))
    return (light.unionByName(heavy).groupBy("h", "c")
            .agg(F.flatten(F.collect_list("dups")).alias("dups")))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text, th: what tells the texts of one doc_id (or of none) apart,
    128 bits (MD5) where there are several, else nothing."""
    own = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    several = settle(docs.groupBy("doc_id").agg(F.min(own).alias("a"), F.max(own).alias("b"))
                     .filter("a <> b").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_several")), "repeated-ids")
    n = several.count()
    if not n:
        return docs.select("doc_id", "text", F.lit(b"").alias("th"))
    several = F.broadcast(several) if n <= BROADCAST_IDS else several
    return docs.join(several, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "text", F.when(F.col("_several"), own).otherwise(F.lit(b"")).alias("th"))


def duplicate_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = GROUP_STRINGS) -> DataFrame:
    """doc_id, th and covered byte ranges (start << 32 | end) of every document
    (``identified``: doc_id, text, th) in which a window also starts earlier; ranges may overlap."""
    found = settle(occurrences(docs, length, gram), "occurrences")
    place = F.struct("doc_id", "th", "lo")
    classes = settle(found.groupBy("h", "c").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("k"), F.max("ctx").alias("ctx"), F.first("off").alias("off")), "contexts")
    contexts = classes.filter("ctx IS NOT NULL").select("h", "c", "ctx", "off", "first.*")
    verdicts = _verdicts(contexts, length, gram, limit)
    judged = settle(classes.select("h", "c", "first", "k").join(verdicts, ["h", "c"], "left")
                    .filter("k > 1 OR dups IS NOT NULL").drop("k"), "judged")
    # both sides are plain tables: a context that a third of all rows share is
    # split by the skew join
    hit = found.select("h", "c", "doc_id", "th", "lo", "n").join(judged, ["h", "c"])
    span = lambda a, b: F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long"))
    whole = F.array(span(F.col("lo"), F.col("lo") + F.col("n") - 1 + length))
    single = F.transform("dups", lambda w: span(F.col("lo") + w, F.col("lo") + w + length))
    ranges = F.when(~place.eqNullSafe(F.col("first")), whole).otherwise(single)
    return hit.select("doc_id", "th", ranges.alias("r")).filter("r IS NOT NULL")


def _merged(spans: DataFrame) -> DataFrame:
    """Per document the sorted, disjoint ranges, packed as little-endian pairs."""
    def step(batch):
        packed, lists = [], batch.column(2)
        values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            own = np.sort(values[i:j])
            start, stop = own >> 32, np.maximum.accumulate(own & 0xFFFFFFFF)
            new = np.flatnonzero(np.concatenate(([True], start[1:] > stop[:-1])))
            packed.append(np.stack([start[new], stop[np.append(new[1:], len(own)) - 1]], 1).astype("<i4").tobytes())
        return {"doc_id": batch.column(0), "th": batch.column(1), "spans": packed}
    rows = spans.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("r")).alias("r"))
    return map_arrow(rows, step, "doc_id long, th binary, spans binary")


def remove_duplicates(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """Every row of docs (doc_id, text) without the bytes covered by a
    ``length``-byte string that also starts earlier: doc_id, n_bytes, n_removed,
    n_spans, kept_sha256 (and the kept bytes with ``keep_text``).

    Earlier is a smaller doc_id or an earlier start in the same document.  Null
    texts are empty; null ids come before all others; repeated rows of one
    doc_id and text count as one document and get the same result; rows of one
    doc_id and different texts are ordered by a hash of the text (MD5, 128
    bits).  Contexts count as equal by two independent 64-bit hashes."""
    docs = identified(docs.select("doc_id", "text"))
    spans = settle(_merged(duplicate_spans(docs, length, gram)), "spans")
    size = spans.agg(F.sum(F.octet_length("spans") + 64)).first()[0] or 0
    own = spans.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "spans")
    rows = docs.join(F.broadcast(own) if size <= BROADCAST_BYTES else own,
                     F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")

    def step(batch):
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for text, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = (text or "").encode("utf-8")
            pairs = np.frombuffer(packed or b"", "<i4").reshape(-1, 2).tolist()
            kept, at = [], 0
            for a, b in pairs:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            for k, v in (("n_bytes", len(raw)), ("n_removed", len(raw) - len(kept)), ("n_spans", len(pairs)),
                         ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept if keep_text else None)):
                out[k].append(v)
        return {"doc_id": batch.column(0), **out}

    return map_arrow(rows.select("doc_id", "text", "spans"), step, "doc_id long, n_bytes long, n_removed long, "
                     "n_spans long, kept_sha256 string" + (", kept binary" if keep_text else ""))
