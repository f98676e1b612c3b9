"""Main text of web pages by a site style tree (operator 9).

The pages of a host are merged into one tree: a node is an element path with
its tags, classes and ids.  A node's importance mixes the entropy of its
presentation styles (child sequences) over the pages with the entropy of its
contents: text that returns on many pages weighs little, text of one page
weighs much.  Branches of low importance are cut from each page.  Elements that markup
itself calls menus, forms, asides and the like have no importance on any host.
A class or id that sounds like one makes a branch only suspect: it is cut if it
is a plain container of at most half of the page's text, inside the main element
by its class alone.  Where a page marks a main element that holds a fair share
of its text, nodes outside it have little importance."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import BROADCAST_IDS, map_arrow, settle

LEAST_PAGES = 5         # a node is judged by its contents from so many pages on
LOW = 0.35              # branches under this importance are cut
CONTENT_SHARE = 0.9     # of the importance; the rest is the presentation's
MAIN_SHARE = 0.25       # of a page's unsuspected text: what a main element must hold to be believed
BROADCAST_NODES = 4_000_000     # unimportant nodes sent to all tasks, at most (32 MB)

# Element names.
SKIPPED = frozenset("script style noscript template svg math head title iframe object select button textarea canvas "
                    "nav header footer aside form menu dialog".split())
RAW = frozenset("script style noscript template title textarea iframe svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr img br input".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote "
                    "figure figcaption".split())
NOISE = frozenset("ad ads adv advert advertisement adverts banner sponsor sponsored promo promotion menu nav navbar "
                  "navigation breadcrumb breadcrumbs sidebar aside widget footer foot header masthead topbar cookie "
                  "cookies consent notice notices gdpr alert popup modal newsletter subscribe subscription signup login "
                  "comment comments reply replies respond discussion share sharing social related recommended "
                  "pagination pager toolbar form search skip copyright legal".split())
ADVERTS = frozenset("ad ads adv advert advertisement adverts sponsor sponsored promo".split())     # inline elements too
# plain containers: what a name can make suspect, outside and inside the main element
CONTAINERS = frozenset("div section ul ol dl table center ins figure".split())
INNER_CONTAINERS = frozenset("div ul ol ins".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
# an opening tag of the key closes an open element of the values
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
MAIN = ("article", "main")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
                    re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _names(attrs: str) -> tuple[frozenset, frozenset, bool]:
    """Words of the classes, of the id, and whether the role is one of noise."""
    words: dict[str, frozenset] = {}
    role = False
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        value = (a or b or c).lower()
        if name.lower() == "role":
            role = value.strip() in NOISE_ROLES
        else:
            words[name.lower()] = frozenset(_SPLIT.split(value))
    return words.get("class", frozenset()), words.get("id", frozenset()), role


class _Page:
    """One pass over the tags of a page: visible blocks with their node paths."""

    def __init__(self, text: str):
        self.blocks: list[tuple] = []    # text, paths, in main, in a container, suspect paths
        self.styles: list[tuple[str, str]] = []                      # node path, child sequence
        self.stack: list[list] = []      # tag, path, noisy, main, container, children, suspect
        self.buffer: list[str] = []
        self.noisy = self.main = self.container = 0
        self.has_main = False
        self._read(text)
        self._judge()

    def _flush(self) -> None:
        if self.buffer:
            block = " ".join(entities.unescape("".join(self.buffer)).split())
            self.buffer = []
            if block:
                self.blocks.append((block, [e[1] for e in self.stack if e[1]], self.main > 0, self.container > 0,
                                    [e[1] for e in self.stack if e[6]]))

    def _open(self, tag: str, attrs: str) -> None:
        classes, own_id, role = _names(attrs)
        main = tag in MAIN
        # a main element is never noise by its role; body and html neither
        noisy = (tag in SKIPPED or role or (tag in INLINE and not ADVERTS.isdisjoint(classes))) and not main and tag not in ("html", "body")
        words, plain = (classes, INNER_CONTAINERS) if self.main else (classes | own_id, CONTAINERS)
        suspect = tag in plain and not NOISE.isdisjoint(words)
        container = self.main > 0 and tag not in TEXTUAL and tag not in INLINE
        style = tag
        for name, a, b, c in _ATTR.findall(attrs) if attrs and tag not in INLINE else ():
            style += f" {name.lower()}={re.sub('[0-9]+', '#', a or b or c)}"
        if self.stack and self.stack[-1][5] is not None and tag not in INLINE:
            kids = self.stack[-1][5]
            if not kids or kids[-1] != style:
                kids.append(style)
        path = "" if tag in INLINE else (next((e[1] for e in reversed(self.stack) if e[1]), "") + ">" + style)
        self.stack.append([tag, path, noisy, main, container, [] if path else None, suspect])
        self.noisy += noisy
        self.main += main
        self.has_main |= main and self.noisy == 0
        self.container += container

    def _close(self) -> None:
        tag, path, noisy, main, container, kids, _ = self.stack.pop()
        if path and not self.noisy and len(self.stack) > 1:
            self.styles.append((path, "|".join(kids)))
        self.noisy -= noisy
        self.main -= main
        self.container -= container

    def _read(self, text: str) -> None:
        at, n = 0, len(text)
        while at < n:
            m = _TOKEN.search(text, at)
            stop = m.start() if m else n
            if stop > at and not self.noisy:
                self.buffer.append(text[at:stop])
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if tag in INLINE:
                if tag == "br" and not self.noisy:
                    self.buffer.append(" ")
                elif tag not in VOID and not m[1] and (_ATTR.search(m[3] or "") or (self.stack and not self.stack[-1][1])):
                    self._open(tag, m[3] or "")              # those within an open one too, so that ends match
                elif m[1]:
                    self._close_inline(tag)
                continue
            if tag in RAW:
                # raw text ends at its own end tag and does not end a block
                if not m[1] and not (m[3] or "").rstrip().endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(text, at)
                    at = end.end() if end else n
                continue
            self._flush()
            if m[1]:
                for k in range(len(self.stack) - 1, -1, -1):
                    if self.stack[k][0] == tag:
                        while len(self.stack) > k:
                            self._close()
                        break
                    # a stray end tag closes nothing beyond its own main, page or noise
                    if self.stack[k][0] in ("html", "body") or (self.stack[k][2] or self.stack[k][3]):
                        break
            elif tag not in VOID:
                if tag not in INLINE and any(e[0] == "p" for e in self.stack[-3:]) and tag in TEXTUAL | {"div", "section", "article"}:
                    self._end_p()
                for other in CLOSES.get(tag, ()):
                    if self.stack and self.stack[-1][0] == other:
                        self._close()
                if tag == "body":
                    while self.stack and self.stack[-1][0] == "head":
                        self._close()
                self._open(tag, m[3] or "")
                if (m[3] or "").rstrip().endswith("/"):
                    self._close()
        self._flush()
        while self.stack:
            self._close()

    def _close_inline(self, tag: str) -> None:
        """Ends the innermost open inline element of that name, if any."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][1]:
                return
            if self.stack[k][0] == tag:
                while len(self.stack) > k:
                    self._close()
                return

    def _judge(self) -> None:
        """Whether the main element is believed, and which blocks go by a name:
        those in a suspect container of at most half of the text."""
        size: Counter = Counter()
        for text, paths, _, _, _ in self.blocks:
            size.update({p: len(text) for p in set(paths)} | {"": len(text)})
        named = [any(2 * size[p] <= size[""] for p in suspects) for *_, suspects in self.blocks]
        total = sum(len(b[0]) for b, gone in zip(self.blocks, named) if not gone and not (b[4] and not b[2]))
        inside = sum(len(b[0]) for b, gone in zip(self.blocks, named) if b[2] and not gone)
        self.has_main = self.has_main and inside >= MAIN_SHARE * total and inside > 0
        self.blocks = [b[:4] for b, gone in zip(self.blocks, named) if not gone]

    def _end_p(self) -> None:
        for k in range(len(self.stack) - 1, max(-1, len(self.stack) - 4), -1):
            if self.stack[k][0] == "p":
                while len(self.stack) > k:
                    self._close()
                return


def _weighted(pages: DataFrame) -> DataFrame:
    """html, host, weight: 1 over the number of the host's pages that have the
    same html, so that copies of a page count as one page.  Only hashes move,
    as long as the repeated ones are few enough to be sent to all tasks."""
    rows = pages.select("html", _host().alias("host")).withColumn("_page", F.xxhash64("host", "html"))
    copies = settle(rows.groupBy("_page").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    return rows.join(copies, "_page", "left").select("html", "host", (1 / F.coalesce("_n", F.lit(1))).alias("weight"))


def node_features(pages: DataFrame) -> DataFrame:
    """host, path, kind (0 text, 1 style, 2 page), feature, n: what each node of
    the style trees showed, a text once per page and copies of a page as one
    page (n sums to whole numbers), counted per batch before anything moves."""
    def step(batch):
        seen: dict = {}
        for text, host, weight in zip(*(batch.column(i).to_pylist() for i in range(3))):
            page = _Page(text or "")
            once = {(_hash(path), 0, _hash(block)) for block, paths, _, _ in page.blocks for path in paths}
            once |= {(path, 2, 0) for path, _, _ in once}
            for path, kind, own in once:
                seen[host, path, kind, own] = seen.get((host, path, kind, own), 0.0) + weight
            for path, style in page.styles:
                key = host, _hash(path), 1, _hash(style)
                seen[key] = seen.get(key, 0.0) + weight
        if not seen:
            return None
        host, path, kind, feature = zip(*seen)
        return {"host": list(host), "path": list(path), "kind": list(kind), "feature": list(feature), "n": list(seen.values())}

    return map_arrow(_weighted(pages), step, "host string, path long, kind int, feature long, n double")


def _cuttable(page: _Page) -> list[list[str]]:
    """The paths of each block at which it may be cut: not html and body, not
    the main element and what is around it, and no node that holds more than
    half of the page's text (of that in main elements, where there are any)."""
    blocks, size = [], Counter()
    for text, paths, main, _ in page.blocks:
        tags = [p[len(q) + 1:].split(" ", 1)[0] for p, q in zip(paths, ["", *paths])]
        outer = next((k + 1 for k, tag in enumerate(tags) if main and tag in MAIN), 0)
        blocks.append([p for k, (p, tag) in enumerate(zip(paths, tags)) if k >= outer and tag not in ("html", "body")])
        if main or not page.has_main:
            size.update({p: len(text) for p in set(paths)} | {"": len(text)})
    return [[p for p in paths if 2 * size[p] <= size[""]] for paths in blocks]


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, has_main and the visible blocks of every page (text,
    paths to cut it at as hashes, in main, in a container of main).  Null html has no
    blocks."""
    at = pages.select("page_id", "url", "html", _host().alias("host"))
    schema = ("page_id long, url string, host string, has_main boolean, "
              "blocks array<struct<text:string,paths:array<bigint>,main:boolean,inside:boolean>>")

    def step(batch):
        made = [_Page(t or "") for t in batch.column(2).to_pylist()]
        return {
            "page_id": batch.column(0), "url": batch.column(1), "host": batch.column(3),
            "has_main": [p.has_main for p in made],
            "blocks": [[{"text": t, "paths": [_hash(x) for x in paths], "main": m, "inside": c}
                        for (t, _, m, c), paths in zip(p.blocks, _cuttable(p))] for p in made],
        }
    return map_arrow(at, step, schema)


def _host():
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.lower(F.regexp_extract(F.coalesce(rest, F.lit("")), "^([^/?#]*)", 1))


def importance(features: DataFrame) -> DataFrame:
    """host, path, importance of every node of the style trees.

    Content: 1 minus the mean, over the node's texts (once per page), of
    log(pages that share the text) / log(pages of the node).  Presentation: the
    entropy of its child sequences over the same logarithm.  Everything is
    counted by (host, path, feature) before it meets, so a host with a third
    of all pages is spread over its texts."""
    each = features.groupBy("host", "path", "kind", "feature").agg(F.round(F.sum("n")).cast("long").alias("c"))
    own = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    clog = F.col("c") * F.log(F.col("c").cast("double"))
    nodes = each.groupBy("host", "path").agg(own(0, F.col("c")).alias("t_n"), own(0, clog).alias("t_clog"),
                                             own(1, F.col("c")).alias("s_n"), own(1, clog).alias("s_clog"),
                                             own(2, F.col("c")).alias("pages"))
    pages = F.col("pages").cast("double")
    log_m = F.log(pages)
    content_score = 1 - F.least(F.lit(1.0), F.try_divide(F.try_divide("t_clog", "t_n"), log_m))
    look_score = F.least(F.lit(1.0), F.try_divide(F.log(F.col("s_n").cast("double")) - F.try_divide("s_clog", "s_n"),
                                                   F.log(F.col("s_n").cast("double"))))
    mixed = CONTENT_SHARE * content_score + (1 - CONTENT_SHARE) * F.coalesce(look_score, F.lit(0.0))
    return (nodes.filter("t_n IS NOT NULL")
            .select("host", "path", F.when(pages < LEAST_PAGES, 1.0).otherwise(mixed).alias("importance")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html).

    Inside the main element only containers (no paragraphs, lists, tables,
    headings standing in it directly) can be cut for their contents; outside
    it nothing stays; pages without one (or with one of hardly any text) keep
    every important branch.  A node that holds most of a page's text is never
    cut there.  Null html is an empty page; equal rows, null and repeated
    page_ids are rows of their own; other columns are not read."""
    low = settle(importance(node_features(pages)).filter(F.col("importance") < LOW).groupBy("host")
                 .agg(F.collect_set("path").alias("low")), "low")
    nodes = low.agg(F.sum(F.size("low") + 8)).first()[0] or 0
    low = F.broadcast(low) if nodes <= BROADCAST_NODES else low
    # pages are read again rather than kept: parsing costs less than moving them
    joined = (read_pages(pages).join(low, "host", "left")
              .withColumn("low", F.coalesce("low", F.array().cast("array<bigint>"))))
    cut = lambda b: F.size(F.array_intersect(b["paths"], F.col("low"))) > 0
    keep = F.filter("blocks", lambda b: F.when(F.col("has_main"), b["main"] & ~(b["inside"] & cut(b))).otherwise(~cut(b)))
    text = F.array_join(F.transform(keep, lambda b: b["text"]), "\n\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
