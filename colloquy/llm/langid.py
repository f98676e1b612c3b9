"""Language of texts that may mix languages (operator 13).

Every word gets a score per language from its letter pairs and triples
(hashed counts of the learning documents, log odds against the mean of the
languages).  The script of a word narrows the candidates: languages whose
learning texts do not write it are out.  A Viterbi pass over the words, with a
penalty for every switch, labels each word; runs of one label are the spans,
and the language with most letters in its spans is the document's."""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Column
from pyspark.sql import functions as F

from colloquy.llm.common import _arrow_schema, to_batch

BUCKETS = 1 << 16          # hashed letter pairs and triples
SMOOTHING = 0.5            # added to every count
SWITCH = 8.0               # log odds that a change of language costs
SCRIPT_SHARE = 0.005       # of a language's letters: what makes a script its own
CHARS = 1 << 20            # characters scored at a time
STEP = 256                 # words of a Viterbi chunk
UNKNOWN = "und"

# --- fixed values: main code point ranges of scripts --------------------------
SCRIPTS = [
    ("Latin", 0x41, 0x24F), ("Latin", 0x1E00, 0x1EFF), ("Latin", 0xFF21, 0xFF5A),
    ("Greek", 0x370, 0x3FF), ("Greek", 0x1F00, 0x1FFF),
    ("Cyrillic", 0x400, 0x52F), ("Armenian", 0x530, 0x58F), ("Hebrew", 0x590, 0x5FF),
    ("Arabic", 0x600, 0x6FF), ("Arabic", 0x750, 0x77F), ("Arabic", 0xFB50, 0xFDFF), ("Arabic", 0xFE70, 0xFEFF),
    ("Devanagari", 0x900, 0x97F), ("Bengali", 0x980, 0x9FF), ("Gurmukhi", 0xA00, 0xA7F), ("Gujarati", 0xA80, 0xAFF),
    ("Tamil", 0xB80, 0xBFF), ("Telugu", 0xC00, 0xC7F), ("Kannada", 0xC80, 0xCFF), ("Malayalam", 0xD00, 0xD7F),
    ("Sinhala", 0xD80, 0xDFF), ("Thai", 0xE00, 0xE7F), ("Lao", 0xE80, 0xEFF), ("Tibetan", 0xF00, 0xFFF),
    ("Myanmar", 0x1000, 0x109F), ("Georgian", 0x10A0, 0x10FF), ("Ethiopic", 0x1200, 0x139F), ("Khmer", 0x1780, 0x17FF),
    ("Hangul", 0x1100, 0x11FF), ("Hangul", 0xAC00, 0xD7AF), ("Kana", 0x3040, 0x30FF),
    ("Han", 0x3400, 0x4DBF), ("Han", 0x4E00, 0x9FFF), ("Han", 0xF900, 0xFAFF), ("Han", 0x20000, 0x323AF),
]
# -------------------------------------------------------------------------------
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


def held_out(doc_id) -> Column:
    """Documents that are never learned from: crc32 of the id's text divisible
    by 5, and those without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: 2 letter, 1 mark within words, 0 other; the lower-case
    letter; the script."""
    top = 0x110000
    kind, lower, script = np.zeros(top, np.uint8), np.arange(top, dtype=np.uint32), np.zeros(top, np.uint8)
    for c in range(0x33480):                                 # no letters beyond
        ch = chr(c)
        if ch.isalpha():
            kind[c] = 2
            low = ch.lower()
            lower[c] = ord(low) if len(low) == 1 else c
        elif unicodedata.category(ch)[0] == "M":
            kind[c] = 1
    for name, a, b in SCRIPTS:
        script[a:b + 1] = SCRIPT_NAMES.index(name)
    return kind, lower, script


@dataclass
class Words:
    """The words of some texts, end to end."""

    stream: np.ndarray     # lower-case letters of all words, a 0 before, between and behind
    first: np.ndarray      # per word: place of its first letter in the stream
    start: np.ndarray      # per word: code points of its text before it ...
    end: np.ndarray        # ... and up to its end
    letters: np.ndarray    # per word
    script: np.ndarray     # per word: the script of most of its letters
    bounds: np.ndarray     # per text: its first word (one more at the end)


def words_of(texts: list[str | None]) -> Words:
    kind, lower, script = _tables()
    text = "\n" + "".join([(t or "") + "\n" for t in texts])
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    place = np.concatenate([[1], 1 + np.cumsum([len(t or "") + 1 for t in texts])]).astype(np.int64)
    is_letter = kind[code] == 2
    inside = kind[code] > 0
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    keep = inside.copy()
    keep[0] = True
    keep[ends] = True
    stream = np.where(inside, lower[code], 0)[keep]
    first = np.concatenate([[0], np.cumsum(ends - begins + 1)])[:-1] + 1 if len(begins) else np.empty(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(is_letter)])
    letters = sums[ends] - sums[begins]
    word = np.repeat(np.arange(len(begins)), ends - begins)[is_letter[inside]]
    votes = np.bincount(word * len(SCRIPT_NAMES) + script[code[is_letter]], minlength=len(begins) * len(SCRIPT_NAMES))
    most = votes.reshape(len(begins), -1).argmax(1) if len(begins) else np.empty(0, np.int64)
    bounds = np.searchsorted(begins, place)
    base = place[np.searchsorted(place, begins, "right") - 1]
    return Words(stream, first, begins - base, ends - base, letters, most, bounds)


def grams(w: Words):
    """Buckets of the letter pairs and triples (word ends included) and the
    word of each, in slices of bounded size."""
    s = w.stream.astype(np.uint64)
    starts = np.zeros(len(s), np.int64)
    starts[w.first] = 1
    owner = np.cumsum(starts) - 1                            # the 0 behind a word belongs to it
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    for lo in range(1, len(s), CHARS):
        hi = min(lo + CHARS, len(s))
        two = s[lo - 1:hi - 1] * a + s[lo:hi]
        yield owner[lo:hi], _bucket(two * b)
        from_ = max(lo, 2)
        three = ((s[from_ - 2:hi - 2] * a + s[from_ - 1:hi - 1]) * a + s[from_:hi]) * b
        whole = s[from_ - 1:hi - 1] != 0                     # not across a word's begin
        yield owner[from_:hi][whole], _bucket(three[whole] ^ np.uint64(1 << 63))


def _bucket(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return (h >> np.uint64(48)).astype(np.int64) % BUCKETS


def _groups(batch, column: int):
    """Row ranges of a batch of about CHARS characters (one text at least)."""
    texts = batch.column(column).to_pylist()
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHARS or i + 1 == len(texts):
            yield a, texts[a:i + 1]
            a, size = i + 1, 0


@dataclass
class Model:
    langs: list[str]
    odds: np.ndarray       # bucket x language: log odds against the mean of the languages
    writes: np.ndarray     # script x language: whether the language is written in it


def train(docs: DataFrame) -> Model:
    """Counts over all learning documents (doc_id, text, lang): not held out,
    with a language.  One frame of (language, bucket) counts and one of
    (language, script) letters reaches the driver; both are bounded by the
    number of languages."""
    spark = docs.sparkSession
    known = docs.select("doc_id", "text", "lang").filter(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = sorted(r[0] for r in known.select("lang").distinct().collect())      # the classes
    number = {lang: i for i, lang in enumerate(langs)}
    n_scripts = len(SCRIPT_NAMES)

    def count(batches):
        seen = np.zeros((len(langs), BUCKETS + n_scripts), np.int64)
        for batch in batches:
            names = batch.column(1).to_pylist()
            for a, texts in _groups(batch, 0):
                w = words_of(texts)
                lang = np.array([number[x] for x in names[a:a + len(texts)]], np.int64)
                of_word = np.repeat(lang, np.diff(w.bounds))
                for owner, bucket in grams(w):
                    seen[:, :BUCKETS] += np.bincount(of_word[owner] * BUCKETS + bucket, minlength=len(langs) * BUCKETS).reshape(-1, BUCKETS)
                np.add.at(seen, (of_word, BUCKETS + w.script), w.letters)
        lang, place = np.nonzero(seen)
        yield to_batch({"lang": lang, "place": place, "n": seen[lang, place]}, schema)

    schema = _arrow_schema(spark, "lang int, place int, n long")
    sums = known.select("text", "lang").mapInArrow(count, "lang int, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    got = sums.toArrow().to_pydict() if langs else {"lang": [], "place": [], "n": []}
    seen = np.zeros((len(langs), BUCKETS + n_scripts))
    seen[got["lang"], got["place"]] = got["n"]
    grams_, letters = seen[:, :BUCKETS], seen[:, BUCKETS:]
    share = (grams_ + SMOOTHING) / (grams_ + SMOOTHING).sum(1, keepdims=True)
    odds = np.log(share) - np.log(share.mean(0)) if langs else share
    writes = letters >= np.maximum(SCRIPT_SHARE * letters.sum(1, keepdims=True), 1)
    return Model(langs, np.ascontiguousarray(odds.T), np.ascontiguousarray(writes.T))


def word_scores(w: Words, model: Model) -> np.ndarray:
    """word x language.  Languages that do not write the word's script are out
    (unless none does)."""
    scores = np.zeros((len(w.first), len(model.langs)))
    for owner, bucket in grams(w):
        if len(owner):
            at = np.flatnonzero(np.diff(owner, prepend=-1))
            scores[owner[at]] += np.add.reduceat(model.odds[bucket], at, axis=0)
    candidates = model.writes | ~model.writes.any(1, keepdims=True)
    scores[~candidates[w.script]] = -1e6
    return scores


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best labels of the words of every text (first word: ``bounds``), where
    a change of label costs ``switch``.  Texts are cut into chunks of STEP
    words; the best way through a chunk from every label to every label puts
    them together again, so all chunks of all texts advance at once."""
    n, size = scores.shape
    labels = np.zeros(n, np.int64)
    sizes = np.diff(bounds)
    pieces = -(-sizes // STEP)
    total = int(pieces.sum())
    if not total or size < 2:
        return labels
    text = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(total) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = bounds[:-1][text] + nth * STEP
    length = np.minimum(STEP, bounds[1:][text] - start)
    order = np.argsort(-length, kind="stable")               # those still running come first
    text, nth, start, length = text[order], nth[order], start[order], length[order]
    running = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length.max()))]
    cost = switch * (1 - np.eye(size))
    through = np.empty((total, size, size))                  # from the label before to the last label
    for t, m in enumerate(running):
        e = scores[start[:m] + t][:, None, :]
        through[:m] = e - cost if t == 0 else np.maximum(through[:m], through[:m].max(2, keepdims=True) - switch) + e
    # entry values of every chunk, text by text in order of the chunks
    entry = np.zeros((total, size))
    at = np.empty((len(sizes), int(pieces.max())), np.int64)
    at[text, nth] = np.arange(total)
    for j in range(1, at.shape[1]):
        more = np.flatnonzero(pieces > j)
        last = at[more, j - 1]
        entry[at[more, j]] = (entry[last][:, :, None] + through[last]).max(1)
    # forward again with known entries, keeping where each label came from
    back = np.empty((len(running), total, size), np.int16)
    value = entry.copy()
    for t, m in enumerate(running):
        jump = value[:m].max(1) - switch
        from_ = value[:m].argmax(1)
        stay = value[:m] >= jump[:, None]
        back[t, :m] = np.where(stay, np.arange(size), from_[:, None])
        value[:m] = np.where(stay, value[:m], jump[:, None]) + scores[start[:m] + t]
    # labels for every possible last label, then the one that is taken
    trace = np.tile(np.arange(size, dtype=np.int16), (total, 1))
    paths = np.empty((len(running), total, size), np.int16)
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        paths[t, :m] = trace[:m]
        trace[:m] = np.take_along_axis(back[t, :m], trace[:m].astype(np.int64), 1)
    leave = np.empty(total, np.int64)
    for j in range(at.shape[1] - 1, -1, -1):
        here = np.flatnonzero(pieces > j)
        ends = pieces[here] == j + 1
        chunk = at[here, j]
        leave[chunk[ends]] = value[chunk[ends]].argmax(1)
        on = here[~ends]
        follow = at[on, j + 1] if len(on) else np.empty(0, np.int64)
        leave[chunk[~ends]] = trace[follow, leave[follow]]
    for t, m in enumerate(running):
        labels[start[:m] + t] = paths[t, np.arange(m), leave[:m]]
    return labels


def _weighed(w: Words, scores: np.ndarray, labels: np.ndarray, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the language of most letters (ties: the first by name; -1
    without letters) and its score: its share of the letters times how sure
    its words are against the best other language, on average."""
    n = len(w.bounds) - 1
    text = np.repeat(np.arange(n), np.diff(w.bounds))
    letters = np.bincount(text * n_langs + labels, w.letters, n * n_langs).reshape(n, n_langs)
    best, total = letters.argmax(1), letters.sum(1)
    own = scores[np.arange(len(text)), best[text]] if len(text) else np.empty(0)
    other = scores.copy()
    other[np.arange(len(text)), best[text]] = -np.inf
    mine = (labels == best[text]).astype(float)
    margin = np.clip(own - other.max(1, initial=-np.inf), -30, 30) * mine
    sure = np.bincount(text, margin, n) / np.maximum(np.bincount(text, mine, n), 1)
    share = letters[np.arange(n), best] / np.maximum(total, 1)
    return np.where(total > 0, best, -1), np.where(total > 0, share / (1 + np.exp(-sure)), 0.0)


def predict(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text), and
    with ``spans`` the spans: (start, end, lang) in code points, end exclusive.

    Null texts and texts without a letter are ``und`` with score 0, as is
    every text where nothing was learned.  Rows are judged one by one: null
    and repeated ids, other columns and the order of rows make no difference."""
    shape = "doc_id long, lang_pred string, score double"
    shape += ", spans array<struct<start:int,end:int,lang:string>>" if spans else ""
    schema = _arrow_schema(docs.sparkSession, shape)
    langs = model.langs

    def label(batches):
        for batch in batches:
            pred, sure, marked = [], [], []
            for _, texts in _groups(batch, 1):
                if not langs:
                    pred, sure, marked = pred + [UNKNOWN] * len(texts), sure + [0.0] * len(texts), marked + [[]] * len(texts)
                    continue
                w = words_of(texts)
                scores = word_scores(w, model)
                labels = viterbi(scores, w.bounds)
                best, score = _weighed(w, scores, labels, len(langs))
                pred += [langs[b] if b >= 0 else UNKNOWN for b in best.tolist()]
                sure += score.tolist()
                if spans:
                    marked += [_runs(w, labels, a, b, langs) for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist())]
            out = {"doc_id": batch.column(0), "lang_pred": pred, "score": sure}
            yield to_batch(out | ({"spans": marked} if spans else {}), schema)

    return docs.select("doc_id", "text").mapInArrow(label, shape)


def _runs(w: Words, labels: np.ndarray, a: int, b: int, langs: list[str]) -> list[dict]:
    """Runs of one label among the words a..b of a text."""
    cuts = [a, *(np.flatnonzero(np.diff(labels[a:b])) + a + 1).tolist(), b] if b > a else []
    return [{"start": int(w.start[i]), "end": int(w.end[j - 1]), "lang": langs[labels[i]]} for i, j in zip(cuts, cuts[1:])]
