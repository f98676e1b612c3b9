"""The registered queries over whole tables against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from colloquy.llm import decontam, pii, quality, tokens
from tests.llm.test_units import _plain_base, _simhash

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


def _ids(texts, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path(tokens.WORD_BPE))
    return [np.array([*e.ids, end], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def _pieces(rows, texts):
    ids = dict(zip([d for d, _ in texts], _ids([t for _, t in texts], 0)))
    expected = {(d, k): (a, len(x[a:a + 2048]), zlib.crc32(x[a:a + 2048].tobytes()))
                for d, x in ids.items() for k, a in enumerate(range(0, len(x), 2048))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r.length for r in rows)


def _components(texts):
    fps = np.array([_simhash(t) for _, t in texts], np.uint64)
    ids = [d for d, _ in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return {ids[i]: (f"{int(fps[i]):016x}", ids[find(i)]) for i in range(len(ids))}


def test_all_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_|pipeline", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names


def test_op1(spark, docs):
    rows = E.queries()["op1_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == _components(docs)


def test_op2(spark, docs):
    rows = {r.doc_id: r for r in E.queries()["op2_pii"](spark, SF).collect()}
    for doc, text in docs:
        base = _plain_base(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
        r = rows[doc]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, k, _ in base) for kind in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_op3(spark, docs):
    rows = sorted(E.queries()["op3_token_files"](spark, SF).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, (doc, _), ids in zip(rows, docs, _ids([t for _, t in docs], 1)):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op4(spark, docs):
    n, total = _pieces(E.queries()["op4_packing"](spark, SF).collect(), docs)
    assert n <= 1.03 * -(-total // 2048) + 1


def test_op5(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    v = {r.vec_id: np.floor(64 * np.array(r.embedding, float)).astype(int) for r in rows}
    expected = []
    for q in v:
        if q % 20 == 0:
            best = sorted((-int(v[q] @ x), i) for i, x in v.items() if i != q)[:20]
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, E.queries()["op5_knn"](spark, SF).collect())) == sorted(expected)


def test_op6(spark):
    rules = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{LARGER}/pages.parquet").select("page_id", "url").collect()}
    rows = E.queries()["op6_url_filter"](spark, LARGER).collect()
    assert len(rows) == len(urls)
    for r in rows:
        rest = urls[r.page_id].partition("://")[2]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.lower()
        fit = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit, key=lambda x: len(x[0]), default=(None, None))
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") if verdict is None else r.verdict == verdict


def test_op7(spark, docs):
    rows = {r.doc_id: r for r in E.queries()["op7_suffix_dedup"](spark, SF).collect()}
    seen = set()
    for doc, text in docs:
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                cover[i:i + 100] = b"\1" * 100
            else:
                seen.add(raw[i:i + 100])
        kept = bytes(x for x, c in zip(raw, cover) if not c)
        spans = sum(c and not p for c, p in zip(cover, b"\0" + cover))
        r = rows[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())


def _leaks(docs, items):
    """(doc, item) -> smallest edit distance of the item to any part of the whole text."""
    out = {}
    for item, text in items:
        words = decontam.words_of(text)
        most = int(0.2 * len(words) + 1e-9)
        for doc, t in docs:
            own = decontam.words_of(t)
            if len(words) >= decontam.LEAST_WORDS and len(set(own) & set(words)) >= len(set(words)) - most:
                number = {w: k for k, w in enumerate(set(words))}
                d = decontam.best_distance([number[w] for w in words], [number.get(w, -1) for w in own])
                if d <= most:
                    out[doc, item] = d
    return out


def test_op8(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = E.queries()["op8_decontam"](spark, SF).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in rows} == _leaks(docs, items)
    assert rows


def test_op9(spark):
    import html
    pages = spark.read.parquet(f"{LARGER}/pages.parquet").collect()
    rows = {r.page_id: r for r in E.queries()["op9_main_text"](spark, LARGER).collect()}
    for p in pages:
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?p>|</?h1>", body)]
        text = "\n\n".join(b for b in blocks if b)
        assert (rows[p.page_id].url, rows[p.page_id].text, rows[p.page_id].n_chars) == (p.url, text, len(text))


def test_op10_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in E.queries()["op10_quality"](spark, LARGER).collect()}
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").collect()
    held = [(r.quality, rows[r.doc_id].predicted) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert len(rows) == 1000 and sum(a == b for a, b in held) / len(held) >= 0.97


def test_pipeline(spark, docs):
    import corpus_pipeline
    got = E.queries()["pipeline"](spark, SF).collect()
    # quality
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    text = dict(docs)
    train = sorted(((xxhash_spark(spark, r.doc_id), r.doc_id, r.quality) for r in labels
                    if zlib.crc32(str(r.doc_id).encode()) % 3 != 1))[:quality.TRAIN_DOCS]
    made = [quality.line_features(text[d]) for _, d, _ in sorted(train, key=lambda x: x[1])]
    made = [(f.astype("<f4").astype(float), w.astype("<f4").astype(float)) for f, w in made]
    model = quality.fit(made, np.array([q for _, _, q in sorted(train, key=lambda x: x[1])]))
    kept = [(d, t) for d, t in docs if model.scores([quality.line_features(t)])[0] >= 0.5]
    assert len(kept) < len(docs)
    # near duplicates
    part = _components(kept)
    kept = [(d, t) for d, t in kept if part[d][1] == d]
    # benchmark
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, _ in _leaks(kept, items)}
    kept = [(d, t) for d, t in kept if d not in leaked]
    # personal data
    weights = pii.train(spark.createDataFrame(kept, "doc_id long, text string"))
    kept = [(d, pii.mask_text(t, pii.all_spans(t, pii.base_spans(t), weights))) for d, t in kept]
    # packing
    _pieces(got, kept)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]


def xxhash_spark(spark, doc_id):
    """Spark's xxhash64 of a long: XXH64 of its 8 bytes with seed 42, signed."""
    return int(np.array([xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), 42)], np.uint64).view(np.int64)[0])


def test_stages_on_awkward_documents(spark, hard_docs, no_docs):
    import corpus_pipeline
    extra = [F.lit("en").alias("lang"), F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars")]
    for frame, least in ((hard_docs, 1), (no_docs, 0)):
        docs = frame.select("doc_id", "text", *extra, "th", F.lit(1.0).alias("score"), F.lit(2).alias("fp"))
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.settle(stage(spark, docs, SF), "test")
            assert out.count() >= least
            if name != "packing":
                assert out.columns == corpus_pipeline.COLUMNS
                docs = out


def test_stages_drop_rows_not_ids(spark):
    import corpus_pipeline
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    own = [" ".join(f"{a}{k}" for k in range(60)) for a in "abcd"]
    rows = [(None, own[0]), (None, own[0]), (None, leak), (5, own[1]), (5, own[2]), (5, leak), (3, own[1]), (None, own[1]), (9, own[3])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = corpus_pipeline.keep_unseen(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in seen) == sorted((d or 0, t) for d, t in rows if t != leak)
    kept = corpus_pipeline.keep_distinct(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, own[0]), (5, leak), (3, own[1]), (5, own[2]), (9, own[3])])
