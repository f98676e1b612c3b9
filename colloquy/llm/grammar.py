"""Token files with Re-Pair grammar compression (operator 3).

A file row is one block of whole documents: the rules (pairs of symbols), the
expansion length of every rule, the symbols of all documents, and per document
its id, its ids and its symbols.  Any document, or any id range of it, is
decoded from the rules and its own symbols alone.  The rows are written by
Spark's Parquet writer, so that files live wherever Spark can write and a lost
task leaves nothing behind."""

from __future__ import annotations

import os
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.llm.common import _arrow_schema, map_arrow, settle, shared_dir, to_batch
from colloquy.llm.tokens import encoder

BLOCK_IDS = 1_000_000
ROUNDS = 5
PAIRS_PER_ROUND = 1024
LEAST_COUNT = 16
BROADCAST_BLOCKS = 500_000    # block starts are sent to all tasks up to so many
BLOCKS = ("shard int, block int, first_doc long, n_docs int, n_ids long, n_terminals int, "
          "docs binary, doc_nulls binary, doc_ids binary, doc_symbols binary, "
          "rules binary, rule_lengths binary, symbols binary")


def compress(ids: np.ndarray, ends: np.ndarray, terminals: int, rounds: int = ROUNDS,
             per_round: int = PAIRS_PER_ROUND, least: int = LEAST_COUNT):
    """Re-Pair over ``ids``; ``ends`` are the places of the final id of each
    document, which no pair may span.  Each round counts all neighbouring
    pairs, turns the most frequent ones into rules and replaces them from left
    to right.  Stops when no pair occurs ``least`` times, after ``rounds``, or
    when the symbol space (16 bits less one, or 31 for larger vocabularies) is full.
    Returns (symbols, ends, rules as an n x 2 array)."""
    small = terminals < 1 << 16
    room = ((1 << 16) - 1 if small else 1 << 31) - terminals
    wide, width = (np.uint32, 16) if small else (np.uint64, 32)
    seq, rules, made = ids.astype(np.uint16 if small else np.uint32), [], 0
    for _ in range(rounds):
        if len(seq) < 2 or made >= room:
            break
        pair = seq[:-1].astype(wide)
        pair <<= wide(width)
        pair |= seq[1:]
        inner = ends[ends < len(pair)]
        none = wide(np.iinfo(wide).max)      # no pair: ids stay below the symbol space
        pair[inner] = none
        pair.sort()
        pair = pair[:np.searchsorted(pair, none)]
        if not len(pair):
            break
        starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        counts = np.diff(np.append(starts, len(pair)))
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        k = min(per_round, room - made, len(often))
        # the k most frequent; ties by the pair itself (values are in pair order)
        best = often[np.argsort(-counts[often], kind="stable")[:k]]
        chosen = np.sort(pair[starts[best]]).astype(np.int64)
        left, right = chosen >> width, chosen & ((1 << width) - 1)
        lefts, li = np.unique(left, return_inverse=True)
        rights, ri = np.unique(right, return_inverse=True)
        row, col = np.zeros(terminals + made, np.int32), np.zeros(terminals + made, np.int32)
        row[lefts], col[rights] = np.arange(1, len(lefts) + 1) * (len(rights) + 1), np.arange(1, len(rights) + 1)
        grid = np.zeros((len(lefts) + 1) * (len(rights) + 1), np.int32)
        grid[row[left] + col[right]] = np.arange(1, k + 1)
        place = seq.astype(np.intp)
        cell = row[place[:-1]]
        cell += col[place[1:]]
        cell[inner] = 0                      # no rule there
        rule = grid[cell]
        at = np.flatnonzero(rule != 0)
        # of a run of overlapping pairs take every second one
        head = np.concatenate(([True], np.diff(at) > 1))
        first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        at = at[((np.arange(len(at)) - first) & 1) == 0]
        seq[at] = terminals + made - 1 + rule[at]
        kept = np.ones(len(seq), bool)
        kept[at + 1] = False
        seq = seq[kept]
        ends = ends - np.searchsorted(at + 1, ends, "right")
        rules.append(np.stack([left, right], 1))
        made += k
    return seq, ends, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def rule_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each rule expands to; a rule only uses earlier symbols."""
    out = [1] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (1 if a < terminals else out[a - terminals]) + (1 if b < terminals else out[b - terminals])
    return np.array(out, dtype=np.uint32)


class Grammar:
    """The decoder of one block: flat expansions of every rule."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, terminals: int):
        spelled: list[bytes] = []
        for a, b in rules.tolist():
            spelled.append((a.to_bytes(4, "little") if a < terminals else spelled[a - terminals])
                           + (b.to_bytes(4, "little") if b < terminals else spelled[b - terminals]))
        self.flat = np.concatenate((np.arange(terminals, dtype=np.uint32),
                                    np.frombuffer(b"".join(spelled), "<u4")))
        self.length = np.concatenate((np.ones(terminals, np.int64), lengths.astype(np.int64)))
        self.at = np.cumsum(self.length) - self.length

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.length[symbols]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.at[symbols] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]

    def span(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop`` of a document, expanding only the symbols that
        the expansion lengths say are touched."""
        ends = np.cumsum(self.length[symbols])
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        base = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - base:stop - base]


def _block(shard: int, number: int, docs: list, parts: list[np.ndarray], terminals: int, kind) -> dict:
    lens = np.array([len(p) for p in parts], dtype=np.int64)
    total = int(lens.sum())
    symbols, marks, rules = compress(np.concatenate(parts), np.cumsum(lens) - 1, terminals)
    lengths = rule_lengths(rules, terminals)
    return {
        "shard": shard, "block": number, "first_doc": docs[0], "n_docs": len(docs), "n_ids": total,
        "n_terminals": terminals,
        "docs": np.array([0 if d is None else d for d in docs], "<i8").tobytes(),
        "doc_nulls": bytes(d is None for d in docs),
        "doc_ids": lens.astype("<u4").tobytes(),
        "doc_symbols": np.diff(np.concatenate(([-1], marks))).astype("<u4").tobytes(),
        "rules": rules.astype(kind).tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(),
        "symbols": symbols.astype(kind).tobytes(),
    }


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Ids of every text (null: none) plus the end id, in ascending doc_id order
    (null ids first, equal ids by text), to token files in the folder ``out``.
    Range-partitioned by doc_id; a task holds one block, never a partition."""
    schema = _arrow_schema(docs.sparkSession, BLOCKS)

    def run(batches):
        enc = encoder(path)
        terminals = max(enc.tokenizer.get_vocab_size(), end_id + 1)
        kind = "<u2" if terminals < 1 << 16 else "<u4"
        shard, number, held, ids, parts = TaskContext.get().partitionId(), 0, 0, [], []

        def emit():
            row = _block(shard, number, ids, parts, terminals, kind)
            return to_batch({k: [v] for k, v in row.items()}, schema)

        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), enc.encode_column(batch.column(1))):
                part = np.append(own, enc.dtype.type(end_id))
                if held and held + len(part) > block_ids:
                    yield emit()
                    number, held, ids, parts = number + 1, 0, [], []
                ids.append(doc)
                parts.append(part)
                held += len(part)
        if held:
            yield emit()

    (docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, BLOCKS).write.parquet(out))


def load_block(row: dict):
    """(Grammar, ids of documents, null flags, lengths, symbol bounds, symbols)."""
    kind = "<u2" if row["n_terminals"] < 1 << 16 else "<u4"
    rules = np.frombuffer(row["rules"], kind).reshape(-1, 2).astype(np.int64)
    grammar = Grammar(rules, np.frombuffer(row["rule_lengths"], "<u4"), row["n_terminals"])
    bounds = np.concatenate(([0], np.cumsum(np.frombuffer(row["doc_symbols"], "<u4").astype(np.int64))))
    return (grammar, np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["doc_nulls"], np.uint8).astype(bool),
            np.frombuffer(row["doc_ids"], "<u4").astype(np.int64), bounds,
            np.frombuffer(row["symbols"], kind).astype(np.int64))


def read_documents(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Every document decoded from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (and the ids with ``keep_ids``).

    Starts come from block totals: a sum per shard, a running sum over the
    shards (one row per file task) and a running sum over a shard's blocks."""
    files = spark.read.parquet(path)
    totals = files.select("shard", "block", "n_ids")
    shards = totals.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    prior = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = shards.select("shard", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_before"))
    starts = totals.join(first, "shard").select(
        "shard", "block", (F.col("_before") + F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).alias("_start"))
    starts = settle(starts, "starts")
    placed = files.join(F.broadcast(starts) if starts.count() <= BROADCAST_BLOCKS else starts, ["shard", "block"])
    names = placed.columns

    def step(batch):
        out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
        for k in range(batch.num_rows):
            row = {n: batch.column(i)[k].as_py() for i, n in enumerate(names)}
            grammar, docs, nulls, lens, bounds, symbols = load_block(row)
            ids = grammar.expand(symbols)
            decoded = grammar.length[symbols]
            sizes = np.add.reduceat(decoded, bounds[:-1])
            ends = np.cumsum(sizes)
            raw = ids.astype("<u4").tobytes()
            at = ends - sizes
            out["doc_id"] += [None if z else d for d, z in zip(docs.tolist(), nulls)]
            out["start"] += (at + row["_start"]).tolist()
            out["n_tokens"] += sizes.tolist()
            out["ids_crc32"] += [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), ends.tolist())]
            out["ids"] += [raw[4 * a:4 * b] if keep_ids else None for a, b in zip(at.tolist(), ends.tolist())]
        return out

    return map_arrow(placed, step, "doc_id long, start long, n_tokens long, ids_crc32 long"
                     + (", ids binary" if keep_ids else ""))


def token_folder(spark: SparkSession) -> str:
    """A fresh folder for token files under the shared folder."""
    return f"{shared_dir(spark)}/colloquy-llm/tokens-{os.urandom(8).hex()}"
