"""Personal data by weak supervision (operator 2).

Base patterns and looser candidate patterns propose spans; regex, gazetteer and
context labelers vote on every candidate (for, against, silent).  Votes are
counted per pattern over the whole corpus, expectation-maximisation estimates
how reliable each labeler is, and its posteriors train a logistic span
classifier.  Base spans always stay; other candidates stay when the classifier
is sure."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ddl, map_arrow

KINDS = ("email", "ip", "card", "phone")
SURE = 0.95

# Gazetteers and context words of the labelers.
TLDS = ("com org net edu gov mil int info biz io co de fr es uk us it nl pl ru cn jp br in eu ch at be se no fi dk "
        "pt gr cz ie ca au nz mx ar za kr").split()
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38", "30")
CONTEXT = {
    "email": "email e-mail mail contact write address correo adresse courriel".split(),
    "ip": "ip host server address client from adresse dirección".split(),
    "card": "card visa mastercard amex credit debit karte carte tarjeta payment".split(),
    "phone": "phone tel telephone call mobile fax cell number telefon téléphone teléfono".split(),
}
AGAINST = "version release section chapter isbn order invoice id sku token hash serial commit".split()

# The base patterns of the contract; look-behinds and possessive repeats only
# keep long runs from being tried again from each of their positions.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates of the method.
_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+"
                        r"(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]{1,63}+){1,4}"),
    "card": re.compile(r"(?<![0-9-])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9-])|(?<![0-9-])[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9-])"),
    "phone": re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}:[0-9]{1,5}(?![0-9])"),
}
_LOOSE_HINT = {"email": re.compile(r"[\[(]at[\])]"), "card": re.compile(r"[0-9][\x20-][0-9]"),
               "phone": re.compile(r"[0-9)][\x20.-]?[0-9]{3}[.-][0-9]"), "ip": re.compile(r"[0-9]:[0-9]")}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base rules, by start, then kind as listed."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        hit = _DOMAIN.match(text, at + 1) if start < at else None
        if hit:
            end = hit.end()
            out.append((start, "email", end))
        at = text.find("@", max(at + 1, end if hit else 0))
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), "card", m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), "phone", m.end()))
    out.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return out


def extra_candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Loose matches that touch no base span."""
    taken = sorted((s, e) for s, _, e in base)
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
    out = []
    for kind in KINDS:
        if _LOOSE_HINT[kind].search(text):
            for m in _LOOSE[kind].finditer(text):
                k = bisect.bisect_left(starts, m.end())
                if not (k and reach[k - 1] > m.start()):
                    out.append((m.start(), kind, m.end()))
    return out


def _words_before(text: str, start: int) -> set:
    return set(re.findall(r"[^\W\d_][\w-]*", text[max(0, start - 40):start].lower()))


def votes(text: str, start: int, kind: str, end: int) -> tuple[int, ...]:
    """Votes (1 for, 0 against, 2 silent) of: strict pattern, checksum / range,
    gazetteer, context for, context against, layout."""
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before = _words_before(text, start)
    near = before & set(CONTEXT[kind])
    bad = before & set(AGAINST)
    if kind == "email":
        strict = int("@" in span)
        tail = re.split(r"[.\s\])]+", span.strip())[-1].lower()
        check, gaz = int(span.count("@") == 1 or "at" in span), int(tail in TLDS)
        layout = int(".." not in span)
    elif kind == "ip":
        parts = re.split("[.:]", span)
        strict = int(len(parts) == 4)
        check = int(all(int(p[-9:]) <= 255 for p in parts[:4]))
        gaz = int(parts[0].lstrip("0") not in ("", "0")) if len(parts[0]) < 4 else 0
        layout = int(not any(len(p) > 1 and p[0] == "0" for p in parts[:4]))
    elif kind == "card":
        strict = int(12 <= len(digits) <= 19)
        check, gaz = int(luhn(digits)), int(digits.startswith(ISSUERS))
        layout = 1 if len(span) > len(digits) else 2
    else:
        strict = int(span.startswith("+"))
        check = int(9 <= len(digits) <= 15)
        gaz = int(digits[:1] not in ("0",)) if strict else 2
        layout = int("(" in span or "-" in span or "." in span or " " in span)
    return strict, check, gaz, 1 if near else 2, 0 if bad else 2, layout


def count_votes(docs: DataFrame) -> DataFrame:
    """(kind, votes, n) over all candidates of all texts; counted per batch
    before the shuffle, so rows out are bounded by the number of patterns."""
    def step(batch):
        seen = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                base = base_spans(text)
                for s, kind, e in base + extra_candidates(text, base):
                    seen[kind, "".join(map(str, votes(text, s, kind, e)))] += 1
        return {"kind": [k for k, _ in seen], "votes": [v for _, v in seen], "n": list(seen.values())} if seen else None
    return map_arrow(docs.select("text"), step, "kind string, votes string, n long").groupBy("kind", "votes").agg(
        F.sum("n").alias("n"))


def reliabilities(rows: list[tuple[str, str, int]], rounds: int = 50) -> dict[str, np.ndarray]:
    """Dawid-Skene expectation-maximisation per kind over the vote patterns.
    Returns the posterior of each pattern, keyed ``kind + pattern``."""
    out = {}
    for kind in KINDS:
        own = sorted((v, n) for k, v, n in rows if k == kind)
        if not own:
            continue
        pattern = np.array([[int(c) for c in v] for v, _ in own])
        n = np.array([c for _, c in own], float)
        said = pattern != 2
        # start: the share of votes for, silent labelers left out
        post = ((pattern == 1).sum(1) + 0.5) / (said.sum(1) + 1)
        for _ in range(rounds):
            prior = ((n * post).sum() + 1) / (n.sum() + 2)
            yes = ((n * post)[:, None] * (pattern == 1)).sum(0) + 4
            yes = yes / (((n * post)[:, None] * said).sum(0) + 5)         # P(for | personal), prior 0.8
            no = ((n * (1 - post))[:, None] * (pattern == 1)).sum(0) + 1
            no = no / (((n * (1 - post))[:, None] * said).sum(0) + 5)     # P(for | not), prior 0.2
            like = lambda p: np.where(said, np.where(pattern == 1, np.log(p), np.log(1 - p)), 0).sum(1)
            odds = like(yes) + np.log(prior) - like(no) - np.log(1 - prior)
            post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        out.update({kind + v: p for (v, _), p in zip(own, post)})
    return out


def _features(kind: str, pattern: str) -> np.ndarray:
    f = np.zeros(len(KINDS) * 13)
    at = KINDS.index(kind) * 13
    f[at] = 1
    for k, c in enumerate(pattern):
        if c != "2":
            f[at + 1 + 2 * k + int(c)] = 1
    return f


def train(docs: DataFrame) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the vote features,
    with the EM posteriors as soft labels and the counts as weights.  The driver
    holds one row per vote pattern (at most 4 x 3^6), whatever the corpus."""
    rows = [(r.kind, r.votes, r.n) for r in count_votes(docs).collect()]
    if not rows:
        return np.zeros(len(KINDS) * 13)
    post = reliabilities(rows)
    x = np.stack([_features(k, v) for k, v, _ in rows])
    y = np.array([post[k + v] for k, v, _ in rows])
    n = np.array([c for _, _, c in rows], float)
    n = n / n.mean()
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (n * (y - p)) - 0.05 * w)
    return w


def all_spans(text: str, base: list, weights: np.ndarray, sure: float = SURE) -> list[tuple[int, str, int]]:
    """Base spans and the surely personal candidates among the others."""
    out = list(base)
    for s, kind, e in extra_candidates(text, base):
        f = _features(kind, "".join(map(str, votes(text, s, kind, e))))
        if 1 / (1 + np.exp(-f @ weights)) >= sure:
            out.append((s, kind, e))
    out.sort(key=lambda x: (x[0], KINDS.index(x[1])))
    return out


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Spans of every text (null: empty): doc_id, n_email, n_ip, n_card, n_phone
    (base spans), base_sha256, spans.  Code points, ends exclusive."""
    def step(batch):
        out = {"doc_id": batch.column(0), "base_sha256": [], "spans": [], **{f"n_{k}": [] for k in KINDS}}
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            for k in KINDS:
                out[f"n_{k}"].append(sum(1 for s in base if s[1] == k))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(all_spans(text or "", base, weights)))
        return out
    return map_arrow(docs.select("doc_id", "text"), step, "doc_id long, n_email long, n_ip long, n_card long, "
                     "n_phone long, base_sha256 string, spans string")


def mask_text(text: str, spans: list[tuple[int, str, int]]) -> str:
    """Overlapping spans are masked as one, under the first one's kind."""
    out, at = [], 0
    for s, kind, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with every personal span of ``text`` replaced by ``[KIND]``;
    null texts stay null, other columns are kept."""
    def step(batch):
        cols = {n: batch.column(i) for i, n in enumerate(names)}
        texts = cols["text"].to_pylist()
        cols["text"] = [t and mask_text(t, all_spans(t, base_spans(t), weights)) for t in texts]
        return cols
    names = docs.columns
    return map_arrow(docs, step, ddl(docs))
