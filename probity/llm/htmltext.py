"""Main-text extraction: boosted trees over DOM nodes, hierarchical decoding.

A page is read into its block elements (tags that break text; inline tags only
mark link text).  Every block element gets features: tag, attribute tokens, depth,
text and link density of its subtree, numbers of children, paragraphs, links and
controls, sibling position and share, and whether an ancestor looks like an
article or like a frame.  Gradient-boosted trees give the probability that the
element holds main text.  Decoding picks the labelling of the whole tree of
greatest likelihood in which an element is kept only if its parent is: no kept
node under a dropped one.

Training pages are put together from fixed skeletons (articles in several
wrappings, menus, headers, side bars, notices, adverts, forms, comments,
footers), filled with paragraphs and anchor texts of a bounded sample of the
corpus (``SAMPLE`` pages of at most ``PAGE_CHARS`` characters, chosen by a hash).  Their labels are
known by construction.  Extraction covers every page and its whole html.

Defined cases: null or empty html gives an empty text; unclosed and crossed tags
end at their block; script, style, title and comments never hold text; a button, select,
noscript, object, svg, iframe or template is left out up to its end tag, or, if its
enclosing block ends first, up to the next block tag; equal rows give equal rows.
"""

from __future__ import annotations

import html as htmllib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, PAGE_CHARS, PAGES = 200, 100_000, 700
ROUNDS, DEPTH, BINS, RATE = 60, 4, 32, 0.3

# Fixed values of the HTML standard and of common page vocabulary.
BLOCK = frozenset(
    "html body main article section aside nav header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption blockquote pre figure figcaption form fieldset address details summary dialog menu center "
    "hgroup search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "title", "textarea", "head")            # what follows is no markup until the end tag
MUTE = ("template", "noscript", "iframe", "svg", "select", "button", "object")   # elements whose text is left out
LABELS = ("button", "select")                                    # hold no sections and not each other
SECTIONS = frozenset("html body main article section aside nav header footer form".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
GOOD = ("article", "content", "main", "post", "entry", "story", "body", "text", "blog")
BAD = ("nav", "menu", "header", "head", "footer", "foot", "sidebar", "side", "aside", "widget", "notice", "cookie", "consent",
       "banner", "alert", "ad", "ads", "advert", "advertisement", "sponsor", "promo", "comment", "comments", "reply", "discussion",
       "form", "login", "search", "subscribe", "newsletter", "share", "social", "related", "recommended", "breadcrumb",
       "pagination", "popup", "modal", "toolbar", "disclaimer", "copyright", "topbar", "masthead", "legal", "feedback")
TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "nav", "header", "footer", "aside", "form",
        "table", "td", "blockquote", "pre", "figure", "body", "html", "dl")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?[!?a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_OPENED = re.compile(r"<([a-z][a-z0-9]*)")
_SPLIT = re.compile(r"[^a-z]+")
_MUTED = re.compile(rf"<(?:{'|'.join(MUTE)})\b", re.I)


def _raw_end(tag, s, pos):
    return re.compile(rf"</{tag}\s*>" if tag != "head" else r"</head\s*>|(?=<body[\s>])", re.I).search(s, pos)


def _closed(s: str) -> dict[int, int]:
    """Where the elements of ``MUTE`` end, by where they begin, if they have an end tag within their enclosing block."""
    out: dict[int, int] = {}
    if not _MUTED.search(s):
        return out
    stack, pos = [], 0                     # (tag, where it begins)

    def innermost(names):
        return next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in names), -1)

    while m := _TOKEN.search(s, pos):
        pos = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag in RAW and not closing:
            if not m[3].endswith("/"):
                e = _raw_end(tag, s, pos)
                if not e and tag != "head":
                    break
                pos = e.end() if e else pos
        elif tag in BLOCK or tag in MUTE:
            if closing:
                k = innermost((tag,))
                if k >= 0:
                    if tag in MUTE:
                        out[stack[k][1]] = pos
                    del stack[k:]
            elif not (tag in MUTE and m[3].endswith("/")):
                if tag in SECTIONS:
                    k = innermost(LABELS)
                else:
                    k = innermost((tag,)) if tag in LABELS else -1
                if k >= 0:
                    stack.pop(k)
                stack.append((tag, m.start()))
    return out


class Page:
    """Block elements of one page in document order, and its runs of text."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["html"], [-1], [()]
        self.link, self.links, self.controls = [0], [0], [0]
        self.runs: list[list] = []        # [node, pieces]
        self.read(source)

    def open(self, tag, attrs):
        self.tag.append(tag)
        self.parent.append(self.stack[-1])
        tokens = []
        if "=" in attrs:
            for m in _ATTR.finditer(attrs):
                tokens += [t for t in _SPLIT.split((m[1] or m[2] or m[3] or "").lower()) if t]
        self.attrs.append(tuple(tokens))
        self.link.append(0)
        self.links.append(0)
        self.controls.append(0)
        self.stack.append(len(self.tag) - 1)

    def close_to(self, names, barrier=()):
        """Close the innermost open block of one of the names, if no barrier is in between."""
        for k in range(len(self.stack) - 1, 0, -1):
            t = self.tag[self.stack[k]]
            if t in names:
                del self.stack[k:]
                return True
            if t in barrier:
                return False
        return False

    def read(self, s: str):
        self.stack, self.fresh, anchor, pos, n = [0], True, 0, 0, len(s)
        closed, mute = _closed(s), False
        while pos < n:
            m = _TOKEN.search(s, pos)
            end = m.start() if m else n
            if end > pos and not mute:
                self.text(s[pos:end], anchor)
            if not m:
                return
            pos = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), m[1] == "/"
            if tag in RAW and not closing:
                if m[3].endswith("/"):
                    continue
                if tag == "textarea":
                    self.controls[self.stack[-1]] += 1
                e = _raw_end(tag, s, pos)
                if e:
                    pos = e.end()
                elif tag != "head":
                    return
                self.gap()
            elif tag in MUTE:
                if closing or m[3].endswith("/"):
                    continue
                if tag in LABELS:
                    self.controls[self.stack[-1]] += 1
                mute = m.start() not in closed
                pos = closed.get(m.start(), pos)
                self.gap()
            elif tag in BLOCK:
                self.fresh, mute = True, False
                if closing:
                    self.close_to((tag,), () if tag != "p" else ("div", "article", "section", "body"))
                    anchor = 0 if tag not in ("p",) else anchor
                elif tag == "html":
                    continue
                else:
                    anchor = 0
                    self.close_to(("p",), ("td", "th", "li", "blockquote", "div", "article", "section"))
                    if tag in CLOSED_BY:
                        self.close_to(CLOSED_BY[tag], ("ul", "ol", "dl", "table"))
                    self.open(tag, m[3])
            elif tag == "hr":
                self.fresh = True
            elif tag == "br":
                self.gap()
            elif tag == "a":
                anchor = 0 if closing else 1
                if not closing:
                    self.links[self.stack[-1]] += 1
            elif tag == "input":
                self.controls[self.stack[-1]] += 1

    def gap(self):
        if not self.fresh and self.runs:
            self.runs[-1][1].append(" ")

    def text(self, t, anchor):
        node = self.stack[-1]
        if self.fresh:
            if t.isspace():
                return
            self.runs.append([node, []])
            self.fresh = False
        self.runs[-1][1].append(t)
        if anchor:
            self.link[node] += len(t)

    def blocks(self):
        """(node, text) of the non-empty runs, in page order."""
        out = []
        for node, pieces in self.runs:
            t = "".join(pieces)
            t = " ".join((htmllib.unescape(t) if "&" in t else t).split())
            if t:
                out.append((node, t))
        return out


N_FEATURES = len(TAGS) + 24


def features(page: Page, blocks) -> np.ndarray:
    n = len(page.tag)
    parent = page.parent
    own, runs = np.zeros(n), np.zeros(n)
    for node, t in blocks:
        own[node] += len(t)
        runs[node] += 1
    text, link, links, ctrl = own.copy(), np.array(page.link, float), np.array(page.links, float), np.array(page.controls, float)
    para = np.array([t == "p" for t in page.tag], float)
    nodes, kids = np.ones(n), np.zeros(n)
    longest = own / np.maximum(runs, 1)
    for k in range(n - 1, 0, -1):
        p = parent[k]
        text[p] += text[k]
        link[p] += link[k]
        links[p] += links[k]
        ctrl[p] += ctrl[k]
        para[p] += para[k]
        nodes[p] += nodes[k]
        kids[p] += 1
        longest[p] = max(longest[p], longest[k])
    x = np.zeros((n, N_FEATURES), np.float32)
    good, bad = np.zeros(n), np.zeros(n)
    depth, up_good, up_bad, art, seen = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), {}
    frame = ("nav", "footer", "aside", "form", "header", "menu", "dialog")
    for k in range(n):
        tokens = page.attrs[k]
        good[k] = sum(t in GOOD for t in tokens)
        bad[k] = sum(t in BAD for t in tokens)
        tag, p = page.tag[k], parent[k]
        if tag in TAGS:
            x[k, TAGS.index(tag)] = 1
        if p >= 0:
            depth[k] = depth[p] + 1
            up_good[k] = max(up_good[p], good[p])
            up_bad[k] = max(up_bad[p], bad[p], page.tag[p] in frame)
            art[k] = max(art[p], page.tag[p] in ("article", "main"))
            seen[p] = seen.get(p, 0) + 1
            x[k, -1] = seen[p]
    f = len(TAGS)
    has_art = float(any(t in ("article", "main") for t in page.tag))
    pa_ = np.maximum(np.array(parent), 0)
    total = max(text[0], 1)
    cols = [good, bad, up_good, up_bad, art, np.full(n, has_art), depth, np.log1p(text), np.log1p(own), text / total,
            link / np.maximum(text, 1), np.log1p(links), ctrl, np.log1p(para), np.log1p(nodes), np.log1p(kids),
            text / np.maximum(nodes, 1), longest, text / np.maximum(text[pa_], 1), kids[pa_], link[pa_] / np.maximum(text[pa_], 1),
            good[pa_], bad[pa_]]
    for i, c in enumerate(cols):
        x[:, f + i] = c
    return x


class Boosted:
    """Gradient-boosted regression trees for the logistic loss, on binned features."""

    def fit(self, x, y):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        b = self.bins(x)
        rate = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        f = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-f))
            tree = self.grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            f += tree[2][self.leaf(tree, b)]
        return self

    def bins(self, x):
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1).astype(np.int16)

    def grow(self, b, g, h):
        size = 2 ** (DEPTH + 1) - 1
        feat, cut, val = np.zeros(size, np.int64), np.full(size, BINS + 1, np.int64), np.zeros(size)
        at = np.zeros(len(g), np.int64)
        for k in range(size):
            m = at == k
            if not m.any():
                continue
            gs, hs = g[m], h[m]
            val[k] = RATE * gs.sum() / (hs.sum() + 1)
            if k >= 2 ** DEPTH - 1:
                continue
            best, whole = 1e-3, gs.sum() ** 2 / (hs.sum() + 1)
            for j in range(b.shape[1]):
                bj = b[m, j]
                gl = np.cumsum(np.bincount(bj, gs, BINS))[:-1]
                hl = np.cumsum(np.bincount(bj, hs, BINS))[:-1]
                gr, hr = gs.sum() - gl, hs.sum() - hl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - whole
                gain[(hl < 1e-2) | (hr < 1e-2)] = -1
                i = int(gain.argmax())
                if gain[i] > best:
                    best, feat[k], cut[k] = gain[i], j, i
            if cut[k] <= BINS:
                at[m] = np.where(b[m, feat[k]] <= cut[k], 2 * k + 1, 2 * k + 2)
        return feat, cut, val

    @staticmethod
    def leaf(tree, b):
        feat, cut, _ = tree
        at, rows = np.zeros(len(b), np.int64), np.arange(len(b))
        for _d in range(DEPTH):
            stop = (cut[at] > BINS) | (at >= 2 ** DEPTH - 1)
            at = np.where(stop, at, 2 * at + 1 + (b[rows, feat[at]] > cut[at]))
        return at

    def margin(self, x):
        b = self.bins(x)
        return self.base + sum(t[2][self.leaf(t, b)] for t in self.trees)


def decode(parent, margin) -> np.ndarray:
    """The best labelling in which a kept node's parent is kept (the root always is)."""
    n = len(parent)
    up = -np.logaddexp(0, -margin)          # log p
    down = -np.logaddexp(0, margin)         # log (1 - p)
    keep, drop = up.copy(), down.copy()
    for k in range(n - 1, 0, -1):
        p = parent[k]
        keep[p] += max(keep[k], drop[k])
        drop[p] += drop[k]
    out = np.zeros(n, bool)
    out[0] = True
    for k in range(1, n):
        out[k] = out[parent[k]] and keep[k] >= drop[k]
    return out


def extract(sources, model) -> list[str]:
    out = []
    for lo in range(0, len(sources), 64):
        pages = [Page(s or "") for s in sources[lo:lo + 64]]
        blocks = [p.blocks() for p in pages]
        xs = [features(p, b) for p, b in zip(pages, blocks)]
        margin = model.margin(np.concatenate(xs))
        at = 0
        for p, b, x in zip(pages, blocks, xs):
            keep = decode(p.parent, margin[at:at + len(x)])
            at += len(x)
            out.append("\n".join(t for node, t in b if keep[node]))
    return out


def _skeleton(rng: random.Random, paras, anchors):
    """One training page: wrapping tags, and pieces (html, is main text) before, inside and after."""
    esc = htmllib.escape
    word = lambda: esc(rng.choice(anchors))
    para = lambda: esc(rng.choice(paras))
    short = lambda: " ".join(esc(rng.choice(paras)).split()[:rng.randint(1, 14)])

    def links(k, wrap="ul"):
        item = "".join(f'<li><a href="/{i}">{word()}</a></li>' for i in range(k))
        return f"<{wrap}>{item}</{wrap}>" if wrap else "".join(f'<a href="/{i}">{word()}</a> ' for i in range(k))

    def bad():
        kind = rng.choice(["nav", "menu", "ad", "aside", "notice", "form", "comments", "share", "related", "header", "footer", "crumbs"])
        name = {"ad": ["ad", "ads", "advert", "banner", "promo", "sponsor"], "notice": ["notice", "cookie", "alert", "cookie-banner", "disclaimer"],
                "comments": ["comments", "comment-list", "discussion"], "aside": ["sidebar", "widget", "side"]}.get(kind, [kind])
        cls = rng.choice([f' class="{rng.choice(name)}"', f' id="{rng.choice(name)}"'])
        if kind in ("nav", "menu"):
            tag = rng.choice(["nav", "div", "nav"])
            return f"<{tag}{'' if tag == 'nav' and rng.random() < .6 else cls.replace(kind, rng.choice(['nav', 'menu', 'navbar nav']))}>{links(rng.randint(2, 8))}</{tag}>"
        if kind in ("ad", "notice"):
            return f"<{rng.choice(['div', 'div', 'aside', 'section'])}{cls}>{rng.choice([short(), '<p>' + short() + '</p>', para()])}"
        if kind == "aside":
            tag = rng.choice(["aside", "div"])
            return f"<{tag}{cls if tag == 'div' or rng.random() < .5 else ''}><h3>{word()}</h3>{rng.choice([links(4), '<p>' + para() + '</p>', '<p>' + short() + '</p>' + links(3)])}</{tag}>"
        if kind == "form":
            return f"<form{rng.choice(['', cls])}><label>{word()}</label><input name=q>{rng.choice(['', '<p>' + short() + '</p>'])}<button>{word()}</button></form>"
        if kind == "comments":
            tag = rng.choice(["div", "section", "div"])
            one = lambda: f'<{rng.choice(["div", "li", "article"])} class="{rng.choice(["comment", "reply"])}"><p>{rng.choice([short(), para()])}</p>'
            return f"<{tag}{cls}><h2>{word()}</h2>{''.join(re.sub(r'^<(.*?) (.*)$', r'<\1 \2</\1>', one(), flags=re.S) for _ in range(rng.randint(1, 4)))}</{tag}>"
        if kind in ("header", "footer"):
            body = rng.choice([f"<p>{short()}</p>", f"&copy; {word()} &middot; {short()}", links(3), f"<h1>{word()}</h1>" + links(3)])
            return f"<{kind}>{body}</{kind}>" if rng.random() < .7 else f'<div class="{kind}">{body}</div>'
        return f"<div{cls}>{rng.choice([links(3), links(3, ''), '<p>' + links(2, '') + '</p>'])}</div>"

    def close(s):
        m = re.match(r"<(\w+)", s)
        return s if s.endswith(f"</{m[1]}>") else s + f"</{m[1]}>"

    wrap = rng.choice(["article"] * 6 + ["main", "div:content", "div:post", "section:entry-content", "div:article-body", "main>article",
                       "div:main>div:story", "article:post"])
    opens, ends = "", ""
    for part in wrap.split(">"):
        tag, _, cls = part.partition(":")
        opens += f"<{tag}" + (rng.choice([f' class="{cls}"', f' id="{cls}"']) if cls else "") + ">"
        ends = f"</{tag}>" + ends
    good = []
    if rng.random() < .8:
        t = rng.choice(["h1", "h1", "h2"])
        good.append(f"<{t}>{rng.choice([short(), word()])}</{t}>")
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
        r = rng.random()
        t = rng.choice([para(), para(), para(), short()])
        if r < .78:
            good.append(f"<p>{t}</p>" if rng.random() < .7 else f"<p><b>{t}<br><p>{para()}</p>")
        elif r < .83:
            good.append(f"<blockquote><p>{t}</p></blockquote>")
        elif r < .88:
            good.append("<ul>" + "".join(f"<li>{short()}</li>" for _ in range(3)) + "</ul>")
        elif r < .92:
            good.append(f"<h2>{word()}</h2>")
        elif r < .95:
            good.append(f"<p>{t} <a href='/x'>{word()}</a> {short()}</p>")
        elif r < .97:
            good.append(f"<table><tr><td>{short()}</td><td>{word()}</td></tr></table>")
        else:
            good.append(f"<div>{t}</div>")
    pieces = [(g, True) for g in good]
    if rng.random() < .35:
        for _ in range(rng.randint(1, 2)):
            pieces.insert(rng.randint(0, len(pieces)), (close(bad()), False))
    before = [(close(bad()), False) for _ in range(rng.randint(1, 4))]
    after = [(close(bad()), False) for _ in range(rng.randint(1, 3))]
    return opens, ends, before, pieces, after


def training_pages(paras, anchors, count=PAGES, seed=7):
    """(features, labels) of made-up pages over the given texts."""
    rng, xs, ys = random.Random(seed), [], []
    for _ in range(count):
        opens, ends, before, pieces, after = _skeleton(rng, paras, anchors)
        parts = [("<body>", True), *before, (opens, True), *pieces, (ends, None), *after]
        page = Page("<html>" + "".join(s for s, _ in parts))
        # the pieces are well formed: one node per opening block tag
        y = [1.0]
        for s, good in parts:
            y += [float(bool(good))] * sum(t in BLOCK for t in _OPENED.findall(s))
        y = np.array(y)
        xs.append(features(page, page.blocks()))
        ys.append(y)
    return np.concatenate(xs), np.concatenate(ys)


def train(pages: DataFrame) -> Boosted:
    """Fit on skeletons filled from a bounded sample of ``pages``."""
    usable = pages.filter("html is not null and length(html) > 0").filter(F.length("html") <= PAGE_CHARS).select(
        "html", F.xxhash64("html").alias("h"))
    # the least hashes first (8 bytes each to the driver), then only their pages; equal pages count once
    least = [r["h"] for r in usable.select("h").distinct().orderBy("h").limit(SAMPLE).collect()]
    rows = usable.filter(F.col("h") <= (least[-1] if least else 0)).groupBy("h").agg(
        F.min("html").alias("html")).orderBy("h").collect() if least else []
    paras, anchors = [], []
    for r in rows:
        page = Page(r["html"])
        for node, t in page.blocks():
            (anchors if page.links[node] else paras if page.tag[node] == "p" else anchors).append(t[:4000])
    paras = paras or ["A plain sentence of some words that stands for a paragraph of text."]
    anchors = [" ".join(a.split()[:6]) for a in anchors] or ["Home", "About", "Contact"]
    return Boosted().fit(*training_pages(paras, anchors))


def main_text(pages: DataFrame, model: Boosted) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    def run(batches):
        for batch in batches:
            text = extract(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
