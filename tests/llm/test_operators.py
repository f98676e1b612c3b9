"""Operators on awkward rows: nulls, empty and long texts, ties, repeated
rows, empty tables, clashing column names."""

import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from colloquy.llm import common, decontam, grammar, html, knn, packing, pii, quality, simhash, suffix, tokens, urls


def _ids(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path(tokens.WORD_BPE))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def _hard():
    from tests.llm.conftest import HARD
    return HARD


def test_simhash_awkward_rows(spark, hard_docs, no_docs):
    rows = simhash.near_duplicates(hard_docs).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[5].component_id == by[1].component_id == 1
    assert by[3].fp == 0 and by[3].component_id == by[4].component_id == by[2].component_id == 2
    assert by[None].component_id is None
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_heavy_variants_are_split(spark):
    rng = np.random.default_rng(2)
    base = int(rng.integers(1 << 40))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (80, 2))})
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = []
    for heavy in (4096, 8):
        found = common.components(simhash.links(classes, 4, heavy)).collect()
        roots.append({(r.node, r.root) for r in found})
    assert roots[0] == roots[1] and len({r for _, r in roots[0]}) == 1


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 140)}, 300: 300, 301: 300}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pii_awkward_rows(spark, hard_docs, no_docs):
    weights = pii.train(hard_docs)
    rows = pii.find(hard_docs, weights).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 10 and by[None].n_email == 1 and by[9].n_ip == 1
    assert by[2].spans == "" and by[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(no_docs, pii.train(no_docs)).count() == 0
    masked = {(r.doc_id, r.th): r.text for r in pii.masked(hard_docs, weights).collect()}
    assert masked[None, "e"] == "no id here, mail me at [EMAIL]" and masked[2, "b"] is None


def test_pii_method_adds_sure_candidates(spark):
    rows = [(k, f"phone +1 (555) 555-0{k:03d} or call 555-555-{k:04d} and mail x{k} (at) y.com") for k in range(200)]
    rows += [(1000 + k, f"order serial 555.123.{k:04d} here") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    assert all(found[k].n_phone == 1 and found[k].spans.count("phone") == 2 for k in range(200))


def test_token_files_round_trip(spark, hard_docs, no_docs):
    path = tokens.tokenizer_path(tokens.WORD_BPE)
    out = grammar.token_folder(spark)
    grammar.write_token_files(hard_docs, out, path, end_id=1, block_ids=2_000)
    rows = sorted(grammar.read_documents(spark, out, keep_ids=True).collect(), key=lambda r: r.start)
    expected = sorted(_hard(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc, text, _), ids in zip(rows, expected, _ids(spark, [t for _, t, _ in expected])):
        raw = np.array([*ids, 1], "<u4").tobytes()
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc, start, len(ids) + 1, zlib.crc32(raw))
        assert bytes(row.ids) == raw
        start += len(ids) + 1
    out = grammar.token_folder(spark)
    grammar.write_token_files(no_docs, out, path, end_id=1)
    assert grammar.read_documents(spark, out).count() == 0


def test_packing_awkward_rows(spark, hard_docs, no_docs):
    path = tokens.tokenizer_path(tokens.WORD_BPE)
    pieces = tokens.token_pieces(hard_docs, path, 64, end_id=0, keep_ids=True).withColumn("_x", F.lit(1))
    rows = packing.pack(pieces, 64, buckets=4).collect()
    ids = {(d, t): i + [0] for (d, t, _), i in zip(_hard(), _ids(spark, [t for _, t, _ in _hard()]))}
    assert len(rows) == sum(-(-len(i) // 64) for i in ids.values()) + 1     # doc 5 stands twice
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 and zlib.crc32(bytes(r.ids)) == r.ids_crc32
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(tokens.token_pieces(no_docs, path, 64, 0), 64).count() == 0


def test_knn_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (20, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, []), (7, [1.0]), (40, [-1.0, 3.0, 2.0]), (None, [0.5, -0.25]), (8, [0.5, -0.25])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = knn.search(knn.quantised(vectors), F.col("vec_id") % 20 == 0, k=3, n_pivots=3, cell_rows=2).collect()
    usable = {i: np.floor(64 * np.array(v, float)) for i, v in rows if i is not None and v is not None
              and all(x is not None and np.isfinite(x) for x in v)}
    usable[None] = usable[0]

    def dot(a, b):
        n = min(len(a), len(b))
        return int(a[:n] @ b[:n])

    expected = []
    for q in (0, 20, 40):
        scores = sorted((-dot(usable[q], v), i is None, i or 0) for i, v in usable.items() if i != q)[:3]
        expected += [(q, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(expected)
    empty = knn.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert knn.search(empty, F.col("vec_id") % 20 == 0).count() == 0


def test_knn_equals_brute_force_with_many_ties(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-3, 4, (150, 4)), np.repeat([[1, 2, 3, -1]], 150, 0)]).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = knn.search(vectors, F.col("vec_id") % 20 == 0, k=20, n_pivots=8, cell_rows=16).collect()
    expected = []
    for q in range(0, 300, 20):
        order = sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)[:20]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(order)]
    assert sorted(map(tuple, got)) == expected


def test_knn_scores_of_large_components_are_exact(spark):
    rows = [(0, [1e8] * 4), (1, [1.0] * 4), (2, [-3e8, 2.5, 1.0, 7e7]), (3, [0.25, 1e10, -1e10, 3.0]), (20, [1.0, 2.0, 0.5, 3.0]),
            (4, [1.0, 1.0, 1.0, 0.984375]), (40, [3e9, -1.0, 1.0, 2.0])]
    vectors = knn.quantised(spark.createDataFrame(rows[:2] + rows[4:6], "vec_id long, embedding array<double>"))
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}

    def expected(ids):
        out = []
        for q in (i for i in ids if i % 20 == 0):
            scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in ids if i != q)[:20]
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
        return sorted(out)

    got = knn.search(vectors, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == expected([0, 1, 20, 4])
    assert max(r.score for r in got if r.query_id == 0) > 1_600_000_000_000
    # products of large with large ones: exact as long as they fit 64 bits
    wide = knn.quantised(spark.createDataFrame([rows[i] for i in (1, 2, 4, 5)], "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, knn.search(wide, F.col("vec_id") % 20 == 0, n_pivots=2).collect())) == expected([1, 2, 20, 4])
    with np.testing.assert_raises(Exception):
        far = knn.quantised(spark.createDataFrame([(0, [1e18]), (20, [1e18])], "vec_id long, embedding array<double>"))
        knn.search(far, F.col("vec_id") % 20 == 0).collect()


def test_suffix_dedup_tells_texts_of_one_id_apart(spark):
    # two texts of the same 32-bit hash
    texts = spark.range(300_000).select(F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("t"))
    pair = texts.groupBy(F.hash("t")).agg(F.collect_list("t").alias("t")).filter(F.size("t") > 1).first().t[:2]
    rows = [(1, pair[0]), (7, pair[0]), (7, pair[1]), (None, pair[1][:100] + "x"), (None, "y" + pair[1][50:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = sorted([(r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix.remove_duplicates(docs).collect()])
    # a text repeats its first 64 bytes: 64 of them start nowhere earlier; the
    # rows without an id come first and hold strings of the second text
    assert [r for r in rows if r[0]] == [(1, 256, 192), (7, 256, 256), (7, 256, 256)]
    alone = suffix.remove_duplicates(docs.filter("doc_id IS NOT NULL")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in alone) == [(1, 192), (7, 192), (7, 256)]


def test_urls_rules_and_templates(spark):
    rows = [(1, "http://A.example.NET/en/x?q"), (2, "https://example.net/de/1"), (3, "ftp://x.example.com/de/5#t"),
            (4, "http://org/fr/"), (5, None), (6, "no url"), (7, "http://net"), (8, "http://h.org/frx"), (9, "http://Ä.NET/"),
            (10, "://"), (10, "://"), (None, "http://h.com/a/1"), (11, "http://myexample.net?x/en/")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (by[2].rule, by[2].verdict) == ("net/", "block") and (by[3].rule, by[3].verdict) == ("example.com/de/", "block")
    assert (by[4].rule, by[4].verdict) == ("org/fr/", "allow") and by[8].rule is None
    assert (by[5].host, by[5].path, by[6].host) == ("", "", "") and (by[7].host, by[7].path, by[7].rule) == ("net", "", None)
    assert (by[9].host, by[11].path) == ("Ä.net", "") and by[10].host == ""
    assert all(r.verdict in ("allow", "block") for r in got)
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_urls_reject_blocked_templates_only(spark):
    shapes = spark.createDataFrame(
        [("h", ["spam", "#"], 50, 40, 39), ("h", ["news", "#"], 50, 40, 0), ("h", ["other"], 10, 0, 0), ("g", [], 5, 0, 0)],
        "host string, shape array<string>, n long, labelled long, blocked long")
    got = {(r.host, tuple(r["shape"])): r.judged for r in urls.template_verdicts(shapes).collect()}
    assert got == {("h", ("spam", "#")): "block", ("h", ("news", "#")): "allow", ("h", ("other",)): "allow", ("g", ()): "allow"}


def test_urls_rare_branches_are_judged_by_themselves(spark):
    slug = lambda k: chr(97 + k % 26) + chr(97 + k // 26)
    shapes = spark.createDataFrame(
        [("h", ["s" + slug(k), "t" + slug(k), "x"], 5, 0, 0) for k in range(600)]
        + [("h", ["de", "u" + slug(k), "x"], 1, 1, 1) for k in range(15)],
        "host string, shape array<string>, n long, labelled long, blocked long")
    got = {r["shape"][0]: r.judged for r in urls.template_verdicts(shapes).collect()}
    assert {k for k, v in got.items() if v == "block"} == {"de"}


def test_suffix_awkward_rows(spark, hard_docs, no_docs):
    for limit in (1024, 2):
        spans = suffix.duplicate_spans(suffix.identified(hard_docs), 20, 8, limit)
        assert spans.count() > 0
    rows = suffix.remove_duplicates(hard_docs, 20, 8, keep_text=True).collect()
    seen = set()
    distinct = sorted({(d, t) for d, t, _ in _hard()}, key=lambda r: (r[0] is not None, r[0] or 0))
    expected = {}
    for doc, text in distinct:
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for i in range(len(raw) - 19):
            if raw[i:i + 20] in seen:
                cover[i:i + 20] = b"\1" * 20
            seen.add(raw[i:i + 20])
        kept = bytes(x for x, c in zip(raw, cover) if not c)
        expected[doc] = (len(raw), len(raw) - len(kept), sum(c and not p for c, p in zip(cover, b"\0" + cover)), kept)
    assert len(rows) == 10
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id]
        assert r.kept_sha256 == hashlib.sha256(bytes(r.kept)).hexdigest()
    assert suffix.remove_duplicates(no_docs).count() == 0


def test_decontamination_awkward_rows(spark, hard_docs, no_docs):
    passage = "fox jumps over the lazy dog near the river bank"
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "too short"), (1, passage), (None, passage)],
                                  "item_id long, text string").withColumn("doc_id", F.lit(1))
    for per_pass in (50_000, 1):
        rows = decontam.matches(hard_docs, items, items_per_pass=per_pass).collect()
        assert {r.doc_id for r in rows} == {1, 5} and {r.item_id for r in rows} == {1, None}
        assert all(r.distance == 0 for r in rows)
    assert {r.doc_id for r in decontam.clean(hard_docs, items).collect()} == {2, 3, 4, None, 7, 8, 9}
    assert decontam.matches(no_docs, items).count() == 0
    assert decontam.matches(hard_docs, items.limit(0)).count() == 0


def _page(k, body, main="article"):
    return (f"<html><head><title>t</title></head><body><nav><a href='/'>home {k % 3}</a></nav><div class='x7'>offer {k % 2}</div>"
            f"<{main}><h1>T{k}</h1>{body}</{main}><footer>f</footer></body></html>")


def test_html_awkward_pages(spark):
    rows = [(k, f"http://h.org/{k}", _page(k, f"<p>text {k}</p><p>same</p>")) for k in range(8)]
    rows += [(20, None, None), (21, "u", ""), (21, "u", ""), (None, "http://H.org/", "<p>a&nbsp;b &lt;c&gt;\n d"), (22, "x", "<script>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = html.extract(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    assert all(by[k].text == f"T{k}\n\ntext {k}\n\nsame" and by[k].n_chars == len(by[k].text) for k in range(8))
    assert by[20].text == by[21].text == by[22].text == "" and by[20].n_chars == 0
    assert by[None].text == "a b <c> d"
    assert html.extract(pages.limit(0)).count() == 0


def test_style_tree_cuts_repeated_branches_without_a_main_element(spark):
    rows = [(k, f"http://h.org/{k}", _page(k, f"<p>text number {k}</p>", main="div id='content'").replace("</div id='content'>", "</div>"))
            for k in range(30)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: f"T{k}\n\ntext number {k}" for k in range(30)}


def test_copies_of_a_page_are_no_boilerplate(spark):
    page = lambda body: f"<html><body><div class='content'>{body}</div></body></html>"
    one = "<p>the one text of this host</p><p>and more of it</p>"
    rows = [(k, "http://same.org/", page(one)) for k in range(12)]
    rows += [(100 + k, "http://main.org/", f"<html><body><main><article>{one}</article></main></body></html>") for k in range(12)]
    rows += [(200 + k, "http://mixed.org/", page(one)) for k in range(30)]
    rows += [(300 + k, "http://mixed.org/", page(f"<p>unique text {k}</p><p>further {k}</p>")) for k in range(8)]
    rows += [(400 + k, "http://twice.org/", page(f"<p>own {k}</p>" * 6 + "<div class='x7'>offer</div>")) for k in range(8)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == "the one text of this host\n\nand more of it" for k in got if k < 300)
    assert all(got[300 + k] == f"unique text {k}\n\nfurther {k}" for k in range(8))
    assert all(got[400 + k] == "\n\n".join([f"own {k}"] * 6) for k in range(8))


def test_quality_without_labels_and_with_one_class(spark, hard_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(hard_docs, none)
    assert {r.score for r in quality.score(hard_docs, model).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (3, 1), (7, None), (None, 1), (8, 5)], "doc_id long, quality int")
    scores = [r.score for r in quality.score(hard_docs, quality.train(hard_docs, one)).collect()]
    assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)
    assert quality.score(no_docs, model).count() == 0


def test_quality_learns_and_ignores_held_out_labels(spark):
    good = [(k, "A plain sentence with words.\nAnother line of ordinary prose follows here.") for k in range(0, 120)]
    bad = [(k, "BUY!! NOW!! $$$ ### $$$\nFREE!! $$$ ### WIN!!") for k in range(200, 320)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 200)) for k, _ in good + bad], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    second = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, flipped)).collect()}
    assert first == second
    assert all((s >= 0.5) == (k < 200) for k, s in first.items())


def test_no_name_alone_loses_or_leaks_article_text(spark):
    long = " ".join(f"word{i}" for i in range(60))
    cases = {
        1: ("<body><article><h1>T</h1><p>a b c d</p><section id='discussion'><p>e f</p></section><h2 id='social-impact'>g</h2>"
            "<p class='form'>h</p></article></body>", "T|a b c d|e f|g|h"),
        2: ("<body><article><p>x <span class='advert'>buy <span>now</span> cheap</span> y</p></article></body>", "x y"),
        3: (f"<body><article><h2>teaser</h2></article><div class='content'><p>{long}</p></div></body>", "teaser|" + long),
        4: (f"<body><main><p>intro</p></main><div><p>{long}</p></div></body>", "intro|" + long),
        5: (f"<body><div class='page-with-sidebar'><p>{long}</p><div class='sidebar'><p>links</p></div></div></body>", long),
        6: (f"<body><article><p>{long}</p><div class='comments'><p>first!</p></div><div class='share-buttons'>tweet</div></article>"
            "<div class='ad'>unique advert</div></body>", long),
        7: ("<body><div class='ad'>a long advert of many words here</div><article><p>hi</p></article></body>", "hi"),
        8: (f"<body><p>a <b><i class='x'>b</b> c</i> d</p><div role='navigation'>menu</div><p>{long}</p></body>", "a b c d|" + long),
        9: ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        10: ("<p>" + "very long " * 200_000 + "</p>", ("very long " * 200_000).strip()),
    }
    rows = [(i, f"http://h{i}.example/", h) for i, (h, _) in cases.items()] + [(None, None, cases[2][0]), (2, None, cases[2][0])]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 12
    for r in got:
        assert r.text == cases[r.page_id or 2][1].replace("|", "\n\n"), r.page_id


def _plain_templates(shapes):
    """The template tree in plain Python: shapes as (host, segments, n, labelled, blocked)."""
    out = {}

    def walk(members, up, level, root=False):
        n, lab, blk = (sum(m[k] for m in members) for k in (2, 3, 4))
        purity = (blk + urls.SMOOTH * (0.0 if root else urls.DAMP * up)) / (lab + urls.SMOOTH)
        tails = {tuple(m[1][level:]) for m in members}
        if n < urls.MIN_ROWS or len(tails) == 1 or lab == 0 or (lab == n and blk in (0, lab)):
            for m in members:
                out[m[0], tuple(m[1])] = "block" if purity >= urls.REJECT else "allow"
            return
        while len({m[1][level] if len(m[1]) > level else None for m in members}) == 1:
            level += 1
        kids = {}
        for m in members:
            kids.setdefault(m[1][level] if len(m[1]) > level else "$", []).append(m)
        merged = {}
        for name, own in kids.items():
            kn, kl, kb = (sum(m[k] for m in own) for k in (2, 3, 4))
            rest = lab - kl
            differs = False
            if kl and rest:
                pooled = blk / lab
                error = (pooled * (1 - pooled) * (1 / kl + 1 / rest)) ** 0.5
                differs = error > 0 and abs(kb / kl - (blk - kb) / rest) >= urls.Z * error
            mixed = (kl == 0 and rest > 0) or (kl > 0 and rest == 0)
            keep = name == "$" or (kn >= urls.MIN_ROWS and (differs or mixed))
            merged.setdefault(name if keep else "*", []).extend(own)
        for own in merged.values():
            walk(own, purity, level + 1)

    for host in {s[0] for s in shapes}:
        walk([s for s in shapes if s[0] == host], 0.0, 0, True)
    return out


def test_url_templates_equal_a_plain_tree(spark):
    rng = np.random.default_rng(11)
    shapes = {}
    for _ in range(400):
        host, size = f"h{rng.integers(3)}", int(rng.integers(0, 6))
        path = tuple(f"{'abc'[int(rng.integers(3))]}{int(rng.integers(2)) if rng.random() < 0.3 else ''}" for _ in range(size))
        n = int(rng.integers(1, 6))
        labelled = int(rng.integers(0, n + 1)) if rng.random() < 0.6 else 0
        blocked = labelled if "b" in path[:2] else int(rng.integers(0, labelled + 1)) if rng.random() < 0.2 else 0
        shapes[host, path] = (host, list(path), n, labelled, blocked)
    # very long paths: alone, three alike, and two that part at the end
    shapes["h0", ("x",) * 2000] = ("h0", ["x"] * 2000, 1, 0, 0)
    shapes["h1", ("y",) * 2000] = ("h1", ["y"] * 2000, 5, 2, 2)
    for last in ("p", "q"):
        shapes["h2", ("z",) * 1500 + (last,)] = ("h2", ["z"] * 1500 + [last], 4, 4 if last == "p" else 0, 4 if last == "p" else 0)
    rows = spark.createDataFrame(list(shapes.values()), "host string, shape array<string>, n long, labelled long, blocked long")
    got = {(r.host, tuple(r.shape)): r.judged for r in urls.template_verdicts(rows).collect()}
    expected = _plain_templates(list(shapes.values()))
    assert got == expected and set(got.values()) == {"block", "allow"}
    assert urls.template_verdicts(rows.limit(0)).count() == 0
