"""Ranked lexical search, vector codes and language spans: plain versions and
awkward rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from colloquy.llm import codes, langid, lexical
from scripts.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _plain_ranking(docs, items, k=10):
    """Every score of every pair, from the definition."""
    held = [(d, Counter(TERM.findall(_lower(t)))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        wanted = TERM.findall(_lower(text))
        got = []
        for d, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in wanted if t in c)
            if score > 0:
                got.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(got, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def _ranked(docs, items, k=10):
    return sorted([tuple(r) for r in lexical.top_documents(docs, items, k).collect()], key=repr)


def test_terms_are_those_of_the_pattern():
    text = "Ab_c d9É漢字-x\x00y\x7fÀZ ſİ\t`{}~🙂"
    assert [t.decode() for t in lexical.terms(text.encode())] == TERM.findall(_lower(text))
    assert lexical.terms(None) == []


def test_ranked_search_awkward_rows(spark, hard_docs, no_docs):
    from tests.llm.conftest import HARD
    texts = [(1, "the lazy dog THE lazy dog"), (2, None), (3, ""), (4, "word word x"), (5, "漢字 0 it's id"), (6, "nowhere"),
             (None, "mail dog")]
    items = spark.createDataFrame([(*t, "x") for t in [*texts, texts[0]]], "item_id long, text string, th string")
    docs = [(d, t) for d, t, _ in HARD]
    assert _ranked(hard_docs, items) == _plain_ranking(docs, texts)
    assert _ranked(hard_docs, items, 2) == _plain_ranking(docs, texts, 2)
    assert _ranked(no_docs, items) == [] and _ranked(hard_docs, items.limit(0)) == []


def test_ranked_search_on_random_texts_prunes_and_equals_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    odds = 1 / np.arange(1, 301)
    odds /= odds.sum()
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 40)), p=odds))) for i in range(700)] + [(700, "w1 w2"), (701, "w1 w2")]
    items = [(i, " ".join(rng.choice(words, 8, p=odds))) for i in range(40)]
    # small leaves and blocks, so that every level and several blocks are used
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 400)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert _ranked(d, i) == _plain_ranking(docs, items)


def test_walk_leaves_out_batches_and_large_values_stay_exact():
    rng = np.random.default_rng(5)
    dim, n = 64, 2000
    rows = [np.unique(rng.integers(0, 8, 5) + 8 * (i // 250)) for i in range(n)]        # like documents lie together
    ids, at = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    worth = rng.integers(1, 1000, len(ids))
    for scale in (1, 10**9):                                   # beyond 2^53 the walk uses 64-bit integers
        weights = rng.integers(1, 9, dim) * scale
        items = [{int(t): 1 for t in np.unique(rng.integers(0, 8, 4) + 8 * (j % 8))} for j in range(24)]
        tree = lexical.ItemTree(items, weights)
        best = lexical.Best(len(items), 5, np.zeros(len(items), np.int64))
        done = lexical.walk(tree, best, np.arange(n), ids, worth, at, np.float64 if scale == 1 else np.int64)
        assert done < n * len(items) / 2
        dense = np.zeros((n, dim), np.int64)
        dense[np.repeat(np.arange(n), np.diff(at)), ids] = worth
        for j, item in enumerate(items):
            score = sum(dense[:, t] * int(weights[t]) for t in item)
            top = np.lexsort((np.arange(n), -score))[:5]
            assert best.found[j][0].tolist() == top.tolist() and best.found[j][1].tolist() == score[top].tolist()


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_vector_codes"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    ours, theirs = rows_of(E.queries()[name](spark, SF).toPandas()), rows_of(con.sql(E.oracle_sql()[name]).df())
    assert ours[0] == theirs[0] and ours[2] == theirs[2] and ours[2]


# --- vector codes ------------------------------------------------------------

def _plain_codes(rows, parts=8, size=16, rounds=6):
    """rows: (vec_id, label, whole numbers); Python integers throughout."""
    dim = max(parts, -(-max(len(v) for _, _, v in rows) // parts) * parts)
    rows = [(i, label, list(v) + [0] * (dim - len(v))) for i, label, v in rows]
    width = dim // parts
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:size]
    books = [[r[2][p * width:(p + 1) * width] for r in first] for p in range(parts)]

    def near(x, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return min(range(len(book)), key=lambda k: (gaps[k], k)), min(gaps)
    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, _, v in rows:
                x = v[p * width:(p + 1) * width]
                held[near(x, books[p])[0]].append(x)
            books[p] = [[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(held, books[p])]
    out = []
    for i, label, v in rows:
        found = [near(v[p * width:(p + 1) * width], books[p]) for p in range(parts)]
        error = sum(d for _, d in found)
        out.append((i, "".join(f"{k:02x}" for k, _ in found), error if error < 2**63 else None))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(out, key=repr), sha


def _frame(spark, rows):
    return spark.createDataFrame([(i, label, v, "x") for i, label, v in rows],
                                 "vec_id long, label int, embedding array<double>, code string").repartition(3)


def _floored(rows):
    return [(i, label, [int(math.floor(4096 * x)) for x in v]) for i, label, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def _coded(spark, rows):
    coded, books = codes.compress(codes.quantised(_frame(spark, rows)))
    out = codes.with_label_errors(coded)
    got = out.collect()
    for r in got:
        errors = [s.error for s in got if s.label == r.label]
        assert None in errors or r.label_error == (sum(errors) if sum(errors) < 2**63 else None)
    return sorted([(r.vec_id, r.code, r.error) for r in got], key=repr), codes.digest(books)


def test_codes_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i) % 3 or None, rng.normal(0, 0.2, 16).tolist()) for i in range(60)]
    rows += [(100, 1, None), (101, 1, [0.1, None] + [0.0] * 14), (102, 1, [float("nan")] * 16), (103, None, [float("inf")] * 16),
             (104, 2, []), (105, 2, [0.5] * 9), (7, 1, rows[7][2]), (None, None, rows[3][2]), (3, 0, rows[4][2])]
    assert _coded(spark, rows) == _plain_codes(_floored(rows))
    few = rows[:5] + [rows[0]]
    assert _coded(spark, few) == _plain_codes(_floored(few))
    none = codes.compress(codes.quantised(_frame(spark, rows).limit(0)))[0]
    assert codes.with_label_errors(none).count() == 0
    assert _coded(spark, [(1, None, []), (2, None, [])])[0] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_codes_of_very_large_components_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 0, (rng.normal(0, 10.0 ** int(rng.integers(0, 12)), 8)).tolist()) for i in range(40)]
    rows += [(100 + i, 1, (rng.normal(0, 0.3, 8)).tolist()) for i in range(40)]
    assert _coded(spark, rows) == _plain_codes(_floored(rows))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(1, 16), st.integers(1, 2000))
def test_cells_never_lose_the_nearest_entry(seed, width, entries, spread):
    rng = np.random.default_rng(seed)
    book = codes.Codebook([tuple(map(int, e)) for e in rng.integers(-spread, spread + 1, (entries, width))])
    for _ in range(2):                                         # the second time from the memo
        x = rng.integers(-2 * spread, 2 * spread + 1, (200, width))
        best, dist = book.assign(x)
        gaps = ((x[:, None] - book.book[None]) ** 2).sum(2)
        assert (best == gaps.argmin(1)).all() and (dist == gaps.min(1)).all()


def test_cells_leave_entries_out_and_are_remembered():
    rng = np.random.default_rng(3)
    book = codes.Codebook([tuple(map(int, e)) for e in rng.integers(-900, 900, (16, 2))])
    x = rng.integers(-900, 900, (4000, 2))
    book.assign(x)
    assert book.evaluated < 0.6 * 16 * len(x) and 0 < len(book.memo) < len(x) / 4
    known = len(book.memo)
    book.assign(x)
    assert len(book.memo) == known


# --- language spans ----------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 3), st.sampled_from([2, 3, 256]))
def test_viterbi_equals_trying_all_labellings(seed, size, step):
    rng = np.random.default_rng(seed)
    bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 8, 3))])
    scores = rng.integers(-3, 4, (bounds[-1], size)).astype(float)
    before, langid.STEP = langid.STEP, step
    try:
        labels = langid.viterbi(scores, bounds, 2.0)
    finally:
        langid.STEP = before
    for a, b in zip(bounds[:-1], bounds[1:]):
        def value(path):
            return sum(scores[a + j, x] for j, x in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
        assert b == a or value(labels[a:b]) == max(map(value, itertools.product(range(size), repeat=int(b - a))))


def test_words_are_runs_of_letters_with_their_places():
    texts = ["Don't  stop, Élan!", None, "", "12 34", "नमस्ते мир a"]
    w = langid.words_of(texts)
    for i, text in enumerate(texts):
        got = [(text[a:b]) for a, b in zip(w.start[w.bounds[i]:w.bounds[i + 1]], w.end[w.bounds[i]:w.bounds[i + 1]])]
        assert got == {0: ["Don", "t", "stop", "Élan"], 4: ["नमस्ते", "мир", "a"]}.get(i, [])
    assert [langid.SCRIPT_NAMES[s] for s in w.script] == ["Latin"] * 4 + ["Devanagari", "Cyrillic", "Latin"]


def _learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    greek = spark.createDataFrame([(10**6 + i, "και το νερο ειναι καλο " * 20, "el") for i in range(10)], docs.schema)
    return langid.train(docs.union(greek)), docs


def test_language_spans_scripts_and_awkward_rows(spark, hard_docs, no_docs):
    model, _ = _learned(spark)
    assert "el" in model.langs
    mixed = "the ing hatin and that was erenan whst. Die einung ist nicht beeine schliche keit und ver. το νερο ειναι"
    rows = spark.createDataFrame([(1, mixed), (2, "το νερο"), (3, None), (4, "12 !?")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(rows, model, spans=True).collect()}
    assert [mixed[s.start:s.end].split()[0] for s in got[1].spans] == ["the", "Die", "το"]
    assert [s.lang for s in got[1].spans] == ["en", "de", "el"]
    assert got[2].lang_pred == "el" and 0.5 < got[2].score <= 1
    assert (got[3].lang_pred, got[3].score, got[3].spans) == (got[4].lang_pred, got[4].score, got[4].spans) == ("und", 0.0, [])
    out = langid.predict(hard_docs, model).collect()
    assert len(out) == 10 and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id in (2, 3, 4)} == {"und"}
    assert langid.predict(no_docs, model).count() == 0
    nothing = langid.train(hard_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(hard_docs, nothing).collect()} == {"und"}


def test_language_on_documents_that_were_not_learned(spark):
    rows = E.queries()["op13_language"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert {r.doc_id: r.held_out for r in rows} == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in truth}
    own = [r for r in rows if r.held_out and truth[r.doc_id] is not None]
    assert sum(r.lang_pred == truth[r.doc_id] for r in own) >= 0.98 * len(own) > 100
