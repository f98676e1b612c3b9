"""Plain parts of the operators against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import anchors, decontam, grammar, html, packing, pii, quality, simhash, suffix, tokens


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=14).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=4))
def test_suffix_order_is_lexicographic(strings):
    expected = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s)))
    assert suffix.suffix_order(strings) == [(k, i) for _, k, i in expected]


def test_anchor_runs_pick_the_leftmost_smallest_gram():
    rng = random.Random(5)
    for _ in range(60):
        docs = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 3, 8, 33, 70]))) for _ in range(rng.randrange(1, 6))]
        length, gram = rng.choice([5, 8, 10]), rng.choice([2, 3, 4])
        data, ends = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([len(d) for d in docs])
        ranges, doc, _, p, lo, hi = anchors.anchor_runs(data, ends, length, gram)
        mask = (1 << (length - gram).bit_length()) - 1
        high = [int(g) | mask for g in ranges.grams(gram)] if len(data) >= gram else []
        expected, start = [], 0
        for k, d in enumerate(docs):
            for s in range(start, start + len(d) - length + 1):
                window = high[s:s + length - gram + 1]
                expected.append((k, s + window.index(min(window)), s))
            start += len(d)
        assert [(int(k), int(q), s) for k, q, a, b in zip(doc, p, lo, hi) for s in range(a, b + 1)] == expected


def _edit(a, t):
    prev = [0] * (len(t) + 1)
    for i, x in enumerate(a):
        cur = [i + 1]
        for j, y in enumerate(t):
            cur.append(min(prev[j] + (x != y), prev[j + 1] + 1, cur[j] + 1))
        prev = cur
    return min(prev)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_best_distance_is_the_edit_distance_to_the_best_part(item, text):
    assert decontam.best_distance(item, text) == _edit(item, text)


def test_decontamination_recall_on_edited_passages():
    rng = random.Random(1)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(3000)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randrange(12, 60)))) for k in range(60)]
    index = decontam.Index(items, 0.8, decontam.REPETITIONS)
    texts = []
    for k, text in items:
        words = text.split()
        for _ in range(int(0.2 * len(words))):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(rng.choices(vocab, k=50) + words + rng.choices(vocab, k=50)))
    found = {(n, i) for n, i, *_ in index.search(texts)}
    assert sum((k, k) in found for k in range(60)) >= 57
    clean = [" ".join(rng.choices(vocab, k=300)) for _ in range(100)]
    assert index.search(clean) == []
    assert index.search([None, "", "a"]) == []


def test_decontamination_misses_no_edited_copy_of_any_length():
    rng = random.Random(3)
    common, rare = [f"w{k}" for k in range(40)], [f"rare{k}" for k in range(900)]
    items = [(k, " ".join(rng.choice(rare) if rng.random() < 0.3 else rng.choice(common) for _ in range(5 + k % 30)))
             for k in range(240)]
    seen = Counter(w for _, text in items for w in text.split())
    index = decontam.Index(items, 0.8, decontam.REPETITIONS)
    texts = []
    for k, text in items:
        words = text.split()
        places = sorted(range(len(words)), key=lambda i: seen[words[i]]) if k % 2 else rng.sample(range(len(words)), len(words))
        for i in places[:int(0.2 * len(words) + 1e-9)]:
            words[i] = "edited"
        texts.append(" ".join(["x"] * 40 + words + ["y"] * 40))
    found = {(n, i) for n, i, *_ in index.search(texts)}
    assert all((k, k) in found for k in range(len(items)))


def test_decontamination_finds_items_whose_first_words_are_missing():
    item = [f"w{k}" for k in range(100)]
    index = decontam.Index([(1, " ".join(item))], 0.8, decontam.REPETITIONS)
    part = " ".join(item[20:] + ["z"] * 5)
    texts = ["a " * 30, part, "b", part, part, None, "c " * 200, part]
    assert index.search(texts) == [(n, 1, 20, 100) for n in (1, 3, 4, 7)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 40), max_size=8))
def test_best_fit_places_every_rank_once_without_gaps(runs):
    fill, placed = {}, {}
    for length, rank, n, first, offset in packing.best_fit(runs, 16):
        for i in range(n):
            assert fill.get(first + i, 0) == offset
            fill[first + i] = offset + length
            assert fill[first + i] <= 16
            placed.setdefault(length, []).append(rank + i)
    assert placed == {k: list(range(n)) for k, n in runs.items()}


def test_best_fit_is_as_tight_as_one_by_one_best_fit():
    rng = random.Random(2)
    for _ in range(20):
        lengths = [rng.randrange(1, 100) for _ in range(200)]
        runs = {n: lengths.count(n) for n in set(lengths)}
        plan = packing.best_fit(runs, 100)
        opened = max(first + n for _, _, n, first, _ in plan)
        gaps = []
        for n in sorted(lengths, reverse=True):
            fit = [g for g in gaps if g >= n]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - n)
            else:
                gaps.append(100 - n)
        assert opened <= len(gaps)


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for _ in range(60):
        parts = [rng.integers(0, 3, rng.integers(1, 40)) for _ in range(rng.integers(1, 6))]
        ends = np.cumsum([len(p) for p in parts]) - 1
        for terminals in (3, 70_000):
            seq, marks, rules = grammar.compress(np.concatenate(parts), ends, terminals, 6, 2, 2)
            g = grammar.Grammar(rules, grammar.rule_lengths(rules, terminals), terminals)
            bounds = np.concatenate(([0], marks + 1))
            for k, part in enumerate(parts):
                own = seq[bounds[k]:bounds[k + 1]].astype(np.int64)
                assert (g.expand(own) == part).all()
                a, b = sorted(rng.integers(0, len(part) + 1, 2))
                assert (g.span(own, a, b) == part[a:b]).all()


def test_grammar_compresses_repeats():
    ids = np.tile(np.arange(50), 400)
    seq, _, rules = grammar.compress(ids, np.array([len(ids) - 1]), 50, rounds=8)
    assert len(seq) < len(ids) / 20 and len(rules)


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(tokens.WORD_BPE)
    library, own = Tokenizer.from_file(path), tokens.TextEncoder(path)
    texts = ["a<|endoftext|>b <|startoftext|> <|x", "it's we'll 'S ’s don't", "ÀÉÎ Ǆ ǅ İstanbul ẞ straße ΣΑΣ ﬁ é ́a",
             "a\xa0b c\x1cd\x85e\tf\r\ng\x0bh", "漢字 かな 한글 🙂👍🏽", "x" * 300 + " " + "é" * 100, "1234 ²³¼ ٣", "", " ",
             "___ -- ...!!! a_b the, THE", "​zero ŉ ſ K Å"]
    rng = random.Random(4)
    letters = "abé'!.1 \n<|ßİΣ́"
    texts += ["".join(rng.choices(letters, k=40)) for _ in range(300)]
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    whole = tokens.TextEncoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))
    assert whole.encode(" a  b\n").tolist() == library.encode(" a  b\n", add_special_tokens=False).ids


def test_encoding_a_column_equals_the_library_and_learns_words_together(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(tokens.WORD_BPE)
    library, rng = Tokenizer.from_file(path), random.Random(5)
    texts = [None, "", " ", "a<|endoftext|>b <|x", " it's we'll don' 'S ’s ", "ÀÉÎ ŉ ǅ İ ẞ ΣΑΣ é ́a é,", "a\xa0b\x1cd\x85e\tf\r\ng\x0bh",
             "漢字 🙂👍🏽", "x" * 300 + " " + "é" * 100, "1234 ²³¼ x1 _a a_ 'a", None, "the The the, THE."]
    texts += ["".join(rng.choices("abé'!.1 \n<|ßİΣ́", k=40)) for _ in range(300)]
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for chunk, cache in ((8_000_000, 1_000_000), (64, 8), (1, 1)):
        monkeypatch.setattr(tokens, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(tokens, "CACHE_WORDS", cache)
        own = tokens.TextEncoder(path)
        for column in (pa.array(texts), pa.array(["x", *texts])[1:], pa.array(texts, pa.large_string())):
            assert [ids.tolist() for ids in own.encode_column(column)] == expected
    assert list(own.encode_column(pa.array([], pa.string()))) == []

    monkeypatch.undo()
    single = []
    monkeypatch.setattr(tokens.TextEncoder, "__missing__", lambda self, word: single.append(word) or self._library(word.decode()))
    own = tokens.TextEncoder(path)
    assert len(list(own.encode_column(pa.array(["Word, word é1 it's"] * 50 + ["<x"])))) == 51
    assert single == [b"<x"]              # plain words never go one by one


def test_encoding_a_column_gives_the_model_joined_pieces_and_keeps_no_plain_words():
    import pyarrow as pa
    from tokenizers import Tokenizer
    path, rng = tokens.tokenizer_path(tokens.WORD_BPE), random.Random(6)
    words = ["".join(rng.choices("abehinostéßüöŉǆ", k=rng.randint(1, 12))) for _ in range(700)]
    words += [chr(c) for c in range(33, 0x250) if chr(c).isprintable() and not chr(c).isspace()]
    texts = [" ".join(w.capitalize() + rng.choice(["", ",", ".", "!?", "'s", "-x1", "\\"]) for w in rng.choices(words, k=60))
             for _ in range(80)] + [" ".join(words), None, ""]
    library, own = Tokenizer.from_file(path), tokens.TextEncoder(path)
    own.model = None                      # no piece goes to the model alone
    assert ([ids.tolist() for ids in own.encode_column(pa.array(texts))]
            == [library.encode(t or "", add_special_tokens=False).ids for t in texts])
    assert own.pieces and not [w for w in own if tokens._PLAIN.fullmatch(w.decode())]
    suffixless = tokens.TextEncoder(path)
    suffixless.token_chars = suffixless.token_chars + 1      # lengths that tell nothing: piece by piece
    assert [ids.tolist() for ids in suffixless.encode_column(pa.array(texts[:9]))] == [
        library.encode(t, add_special_tokens=False).ids for t in texts[:9]]


def _plain_base(text):
    """The base rules with plain patterns, tried at every place."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        odd = [int(d) for d in digits[::-1]]
        total = sum(odd[::2]) + sum(sum(divmod(2 * d, 10)) for d in odd[1::2])
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "-", "+", "1", "25", "4", " ", "(", ")", "x.y", "b@c.d", "10.0.0.1", "0042",
                                 "4111 1111 1111 1111", "+1 (555) 555-0100", "é", ",", "_", "%"]), max_size=18).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == _plain_base(text)


def test_long_runs_are_scanned_once():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+" * 100_000, "a@" * 100_000, "1-" * 100_000, "+1 " * 60_000):
        pii.all_spans(text, pii.base_spans(text), np.zeros(len(pii.KINDS) * 13))


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    trans = rng.normal(size=(2, 2))
    scores = [rng.normal(size=n) for n in (1, 2, 5, 5, 3)]
    got, pairs, logz = quality.marginals(scores, trans)
    all_pairs, total = np.zeros((2, 2)), 0.0
    for s, p in zip(scores, got):
        weight, good, own = 0.0, np.zeros(len(s)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(s)):
            w = np.exp(sum(s[k] * y[k] for k in range(len(s))) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            weight += w
            good += w * np.array(y)
            for a, b in zip(y, y[1:]):
                own[a, b] += w
        assert np.allclose(p, good / weight)
        all_pairs += own / weight
        total += np.log(weight)
    assert np.allclose(pairs, all_pairs) and np.isclose(logz, total)


def test_line_features_of_awkward_texts():
    for text in (None, "", "\n", "a\n\nb\r\n", "é" * 10, "x" * 100_000):
        f, w = quality.line_features(text)
        assert len(f) == len(w) == (text or "").count("\n") + 1
        assert np.isfinite(f).all() and (w >= 1).all()


def _simhash(text):
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_equals_the_definition():
    for text in (None, "", "a", "A b", "a b c d", "a b c d e a b c d e", "Ä\x0bb\x1cc d\x85e f", "w " * 40_000):
        assert simhash.fingerprint(text) == _simhash(text)


def test_segments_keep_one_with_at_most_one_differing_bit():
    rng = random.Random(7)
    for distance in (2, 3, 4, 5, 6):
        parts = simhash.segments(distance)
        assert sum(w for _, w in parts) == 64
        for _ in range(200):
            flips = rng.sample(range(64), distance)
            assert min(sum(a <= f < a + w for f in flips) for a, w in parts) <= 1


def test_run_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 3, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c))
                                            for b, c in rng.integers(0, 62, (40, 2))]]))
    key = np.zeros((len(fps), 2), np.int64)
    links = simhash._batch_links(key, fps, 4)
    assert all(np.bitwise_count(a ^ b) <= 4 for a, b in links)

    def parts(pairs):
        root = {int(x): int(x) for x in fps}
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            a, b = find(int(a)), find(int(b))
            root[max(a, b)] = min(a, b)
        return {x: find(x) for x in root}

    every = [(a, b) for a, b in itertools.combinations(fps, 2) if np.bitwise_count(a ^ b) <= 4]
    assert parts(links) == parts(every)


def test_page_parser():
    page = html._Page("<html><head><title>t</title></head><body><header><h1>x</h1></header><nav><p>m</p></nav><main><p>a &amp; b"
                      "<div class='comments'><p>no</div><ul><li>one<li>two</ul><aside>z</aside><p>c<script>\"</p>\"</script>"
                      " d<br>e</p><div class=\"ad\">buy</div><form>f</form></main><footer>f")
    assert [(t, m) for t, _, m, _ in page.blocks] == [("a & b", True), ("one", True), ("two", True), ("c d e", True)]
    for text in ("", "plain", "<", "<p", "</p>", "<p class='x", "<script>", "a < b > c", "<!-- x", "<p><b><i>" * 500):
        html._Page(text)
