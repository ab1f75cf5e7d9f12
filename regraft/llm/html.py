"""Main text of web pages: gradient-boosted trees over DOM nodes and a consistent choice down the tree.

Each block element is a node with features of its subtree, attributes, depth
and siblings. The trees are fitted on at most ``FIT_PAGES`` pages: nodes under
``article`` or ``main`` are examples of text, those under ``nav``, ``footer``
and the like of what surrounds it. So that the model doesn't lean on these tags
alone, each page is also seen with them replaced by plain ``div`` elements and
with further surroundings put in. Decoding finds the best labelling in which a
node below surroundings is never text and a node below text is no longer
neutral.

Defined results: null and empty pages have an empty text; unclosed, misnested
and cut off markup is read as far as it goes; text outside of any element
belongs to the page's root; if no page of the sample is marked up, everything
but scripts, styles, heads and forms is text. Rows that repeat are extracted
alike, further columns are ignored.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, slices

#: Pages the trees are fitted on, the ones of smallest hash below ``FIT_BYTES``.
FIT_PAGES = 240
FIT_BYTES = 40_000

# Fixed values of HTML: elements by kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
DROPPED = {"head", "script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "svg", "select", "button", "object", "audio", "video", "canvas", "math", "datalist"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "nobr", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
# Attribute tokens that name what an element holds.
FOR_TEXT = "article articlebody body content entry main maincontent page post story text hentry postbody".split()
FOR_OTHER = "ad ads advert advertisement aside author banner bio breadcrumb breadcrumbs caption comment comments consent cookie cookies copyright disclaimer footer footnote form gdpr header login masthead menu meta modal nav navbar navigation newsletter notice overlay pagination pager popup privacy promo promoted related rail reply search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar widget reader discussion respond alert".split()
TEXT_TAGS, OTHER_TAGS = {"article", "main"}, {"nav", "footer", "aside", "header", "form", "menu", "dialog"}
TAGS = ["p", "div", "section", "article", "main", "nav", "ul", "ol", "li", "table", "tr", "td", "h1", "h2", "h3", "header", "footer", "aside", "form", "blockquote", "pre", "body", "html", "dl", "figure"]

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<start2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: list[str]
    children: list[int] = field(default_factory=list)
    dropped: bool = False
    own: int = 0  # letters of text directly below, inline elements included
    linked: int = 0
    marks: int = 0
    inline: int = 0


class Page:
    """Nodes in page order, and pieces of text as (node, text); ``None`` for a blank."""

    def __init__(self, source: str):
        self.nodes = [Node("#page", -1, 0, [])]
        self.pieces: list[tuple[int, str]] = []
        self.breaks: list[int] = []  # index into pieces before which a block begins or ends
        stack: list[tuple[str, int]] = [("#page", 0)]  # element name, its block node
        links = place = 0
        while True:
            found = TOKEN.search(source, place)
            text = source[place : found.start() if found else len(source)]
            if text:
                self.add_text(stack[-1][1], text, links)
            if not found:
                break
            place = found.end()
            if name := found["start"] or found["start2"]:
                name = name.lower()
                attrs = found["attrs"] or found["attrs2"] or ""
                if name in VOID:
                    if name in ("br", "hr", "img"):
                        self.pieces.append((stack[-1][1], " "))
                    continue
                self.close_for(name, stack)
                block = stack[-1][1]
                if name in INLINE:
                    self.nodes[block].inline += 1
                    links += name == "a"
                else:
                    self.breaks.append(len(self.pieces))
                    tokens = [t.lower() for v in NAMES.findall(attrs) for t in SPLIT.findall(v)] if attrs else []
                    self.nodes.append(
                        Node(name, block, self.nodes[block].depth + 1, tokens, [], name in DROPPED or self.nodes[block].dropped)
                    )
                    self.nodes[block].children.append(len(self.nodes) - 1)
                    block = len(self.nodes) - 1
                if name in RAW:
                    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, place)
                    place = end.end() if end else len(source)
                else:
                    stack.append((name, block))
            elif name := found["end"]:
                name = name.lower()
                if name == "p" and all(n != "p" for n, _ in stack):
                    self.breaks.append(len(self.pieces))
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        links = self.leave(stack, i, links)
                        break
                    if name in INLINE and stack[i][0] not in INLINE:
                        break

    def leave(self, stack: list[tuple[str, int]], keep: int, links: int = 0) -> int:
        for name, _ in stack[keep:]:
            if name not in INLINE:
                self.breaks.append(len(self.pieces))
        del stack[keep:]
        return sum(name == "a" for name, _ in stack)

    def close_for(self, name: str, stack: list[tuple[str, int]]) -> None:
        """Ends the elements that a start tag ends without an end tag of theirs."""
        if name in CLOSED_BY:
            ended, within = CLOSED_BY[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in within:
                    break
                if stack[i][0] in ended:
                    self.leave(stack, i)
                    if name != "tr":
                        break
        if name not in INLINE:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    self.leave(stack, i)
                    break
                if stack[i][0] not in INLINE:
                    break

    def add_text(self, block: int, text: str, links: int) -> None:
        if "&" in text:
            text = html.unescape(text)
        node = self.nodes[block]
        if node.dropped:
            return
        self.pieces.append((block, text))
        size = len(text) if not text.isspace() else 0
        node.own += size
        node.linked += size * (links > 0)
        node.marks += text.count(",") + text.count(".")

    def text(self, kept: list[bool]) -> str:
        lines, line, breaks, next_break = [], [], self.breaks, 0
        for i, (block, text) in enumerate(self.pieces):
            begins = False
            while next_break < len(breaks) and breaks[next_break] <= i:
                next_break += 1
                begins = True
            if begins and line:
                lines.append(" ".join("".join(line).split()))
                line = []
            if kept[block]:
                line.append(text)
        lines.append(" ".join("".join(line).split()))
        return "\n".join(x for x in lines if x)


WORDS = {t: 1 for t in FOR_TEXT} | {t: -1 for t in FOR_OTHER}
# Parts of longer tokens that name surroundings.
OTHER_PARTS = ("nav", "menu", "footer", "sidebar", "comment", "cookie", "banner", "advert", "newsletter", "consent", "promo", "sponsor", "widget")


@lru_cache(10_000)
def meaning(token: str) -> int:
    """1 for text, -1 for surroundings, 0 for neither."""
    return WORDS.get(token) or -any(p in token for p in OTHER_PARTS)


TAG_CODE = {t: i + 1 for i, t in enumerate(TAGS)}
N_FEATURES = 25


def features(page: Page) -> np.ndarray:
    """A row for each node."""
    nodes = page.nodes
    count = len(nodes)
    text, linked, marks, size, inline = ([0] * count for _ in range(5))
    for i in range(count - 1, -1, -1):
        n = nodes[i]
        text[i] += n.own
        linked[i] += n.linked
        marks[i] += n.marks
        size[i] += 1
        inline[i] += n.inline
        if i:
            for sums in (text, linked, marks, size, inline):
                sums[n.parent] += sums[i]
    total = text[0] or 1
    good, bad, above_good, above_bad = [0] * count, [0] * count, [0] * count, [0] * count
    rows = np.zeros((count, N_FEATURES))
    for i, n in enumerate(nodes):
        for t in n.tokens:
            kind = meaning(t)
            good[i] += kind > 0
            bad[i] += kind < 0
        own_good = (good[i] > 0) + (n.tag in TEXT_TAGS)
        own_bad = (bad[i] > 0) + (n.tag in OTHER_TAGS)
        siblings = 1
        if i:
            above_good[i] = above_good[n.parent] + own_good
            above_bad[i] = above_bad[n.parent] + own_bad
            siblings = len(nodes[n.parent].children)
        rows[i, :18] = (
            TAG_CODE.get(n.tag, 0), n.depth, len(n.children), math.log1p(text[i]), math.log1p(n.own),
            linked[i] / (text[i] or 1), marks[i] * 20 / (text[i] or 1), math.log1p(text[i] / size[i]), text[i] / total,
            min(good[i], 2), min(bad[i], 2), n.tag in TEXT_TAGS, n.tag in OTHER_TAGS, above_good[i], above_bad[i],
            siblings, inline[i] / size[i], math.log1p(size[i]),
        )
    for i, n in enumerate(nodes):
        family = n.children
        longest = max((text[c] for c in family), default=0)
        for k, c in enumerate(family):
            rows[c, 18] = k / len(family)
            rows[c, 19] = rows[family[k - 1], 3] if k else -1
            rows[c, 20] = rows[family[k + 1], 3] if k + 1 < len(family) else -1
            rows[c, 21] = text[c] / (longest or 1)
            rows[c, 22] = rows[i, 3]
            rows[c, 23] = rows[i, 5]
            rows[c, 24] = rows[i, 0]
    return rows


@dataclass
class Trees:
    """Complete binary trees as arrays (tree, node): feature, threshold; leaf values."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        depth = int(math.log2(self.value.shape[1])) if len(self.value) else 0
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (rows[every, f[at]] > t[at])
            total += v[at - (len(v) - 1)]
        return total


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = 30, depth: int = 4, rate: float = 0.25) -> Trees:
    """Boosting of the logistic loss with histograms of 32 bins."""
    start = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, 32)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, rows.T, strict=True)])
    features_, thresholds, values = [], [], []
    odds = np.full(len(labels), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        gradient, weight = labels - p, p * (1 - p)
        at = np.zeros(len(labels), np.int64)
        f, t = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for node in range(2**depth - 1):
            here = np.flatnonzero(at == node)
            best = 1e-6
            if len(here) >= 20:
                g, w = gradient[here], weight[here]
                whole = g.sum() ** 2 / (w.sum() + 1)
                for k, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[k, here]
                    gs = np.cumsum(np.bincount(b, g, len(c) + 1))
                    ws = np.cumsum(np.bincount(b, w, len(c) + 1))
                    gain = gs[:-1] ** 2 / (ws[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (ws[-1] - ws[:-1] + 1) - whole
                    if gain.max() > best:
                        best, f[node], t[node] = gain.max(), k, c[int(gain.argmax())]
            if len(here):
                at[here] = 2 * node + 1 + (rows[here, f[node]] > t[node])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, gradient, 2**depth) / (np.bincount(leaf, weight, 2**depth) + 1)
        odds += value[leaf]
        features_.append(f), thresholds.append(t), values.append(value)
    return Trees(start, np.array(features_), np.array(thresholds), np.array(values))


NEUTRAL, TEXT, OTHER = 0, 1, 2


def decode(page: Page, log_odds: list[float]) -> list[bool]:
    """The best consistent labels: which nodes are text.

    Below other only other, below text only text or other, below neutral all
    three. A node is neutral at a cost that grows with the text directly in it.
    """
    nodes = page.nodes
    best = [[0.0, 0.0, 0.0] for _ in nodes]  # of the subtree with the node so labelled
    for i in range(len(nodes) - 1, -1, -1):
        n, x = nodes[i], max(min(log_odds[i], 12.0), -12.0)
        weight = 0.2 + math.log1p(n.own)
        scores = best[i]
        scores[NEUTRAL] += -0.3 - 4.0 * weight * (n.own > 0)
        scores[TEXT] += -weight * math.log1p(math.exp(-x))
        scores[OTHER] += -weight * math.log1p(math.exp(x))
        if n.dropped or n.tag == "form":
            scores[TEXT] = scores[NEUTRAL] = -1e9
        if i:
            up = best[n.parent]
            up[NEUTRAL] += max(scores)
            up[TEXT] += max(scores[TEXT], scores[OTHER])
            up[OTHER] += scores[OTHER]
    label = [0] * len(nodes)
    for i, n in enumerate(nodes):
        above = label[n.parent] if i else NEUTRAL
        allowed = ((NEUTRAL, TEXT, OTHER), (TEXT, OTHER), (OTHER,))[above]
        label[i] = max(allowed, key=best[i].__getitem__)
    return [x == TEXT for x in label]


def marked(page: Page) -> list[int | None]:
    """What the markup itself says of each node: 1 text, 0 surroundings, ``None`` nothing."""
    out: list[int | None] = []
    for n in page.nodes:
        above = out[n.parent] if n.parent >= 0 else None
        if n.tag in OTHER_TAGS or any(meaning(t) < 0 for t in n.tokens):
            above = 0
        elif above is None and (n.tag in TEXT_TAGS or "fitarticle" in n.tokens):
            above = 1
        out.append(above)
    return out


def disguised(source: str, draw: random.Random) -> str:
    """The page with other names for its parts and further surroundings; ``fitarticle`` marks the text for fitting."""
    text_names = ["content", "post-content", "entry", "story-body", "main-content", "article-text", ""]
    around = {"nav": ["menu", "navbar", "site-nav", "topnav"], "footer": ["footer", "site-footer", "copyright"], "aside": ["sidebar", "related"], "header": ["header", "masthead"]}
    sentences = re.findall(r"<p>([^<]{20,300})", source) or ["text"]

    def some(n: int) -> str:
        return "".join(f"<p>{draw.choice(sentences)}</p>" for _ in range(n))

    name = draw.choice(text_names)
    source = re.sub(r"<(article|main)\b[^>]*>", lambda m: f'<{draw.choice(["div", "section", "main", "article"])} class="{name} fitarticle">', source)
    source = re.sub(r"</(article|main)>", lambda m: "</article></main></section></div>", source, count=1)
    for tag, names in around.items():
        source = re.sub(rf"<{tag}\b[^>]*>", f'<div class="{draw.choice(names)}">', source)
        source = source.replace(f"</{tag}>", "</div>")
    extra = [
        f'<aside class="{draw.choice(["sidebar", "widget", "related", ""])}"><h3>{draw.choice(sentences)[:20]}</h3><ul><li><a href="/x">{draw.choice(sentences)[:30]}</a></li></ul>{some(1)}</aside>',
        f'<div class="{draw.choice(["comments", "comment-list", "reader-comments"])}">{"".join(f"<div class=comment><p>{draw.choice(sentences)}</p></div>" for _ in range(draw.randint(1, 4)))}</div>',
        f'<div id="{draw.choice(["cookie-notice", "consent", "banner", "newsletter"])}">{some(1)}</div>',
        f'<form class="search"><label>{draw.choice(sentences)[:20]}</label><p>{draw.choice(sentences)[:40]}</p></form>',
        f'<div class="{draw.choice(["ad", "ads", "sponsored", "promo"])}">{some(1)}</div>',
    ]
    draw.shuffle(extra)
    before, after = "".join(extra[: draw.randint(0, 2)]), "".join(extra[2 : 2 + draw.randint(0, 3)])
    source = re.sub(r"(<body\b[^>]*>)", lambda m: m[1] + before, source, count=1)
    inside = f'<div class="{draw.choice(["ad", "advert", "share", "promo"])}">{some(1)}</div>' if draw.random() < 0.4 else ""
    return re.sub(r"(</article>.*?</div>)", lambda m: inside + m[1] + after, source, count=1, flags=re.S)


def fit_pages(sources: list[str], seed: int = 5) -> Trees:
    draw = random.Random(seed)
    rows, labels = [], []
    for source in sources:
        for form in [source, *(disguised(source, draw) for _ in range(3))]:
            page = Page(form)
            said = marked(page)
            for n in page.nodes:
                n.tokens = [t for t in n.tokens if t != "fitarticle"]
            keep = [i for i, x in enumerate(said) if x is not None and not page.nodes[i].dropped]
            if keep:
                rows.append(features(page)[keep])
                labels.extend(said[i] for i in keep)
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Trees(4.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)))
    return fit_trees(np.concatenate(rows), y)


def extract(sources: list[str], trees: Trees) -> list[str]:
    pages = [Page(s) for s in sources]
    odds = trees.log_odds(np.concatenate([features(p) for p in pages])).tolist() if pages else []
    out, at = [], 0
    for page in pages:
        count = len(page.nodes)
        out.append(page.text(decode(page, odds[at : at + count])))
        at += count
    return out


def main_text(pages: DataFrame, sample_size: int = FIT_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    session = pages.sparkSession
    sample = bounded_sample(pages.where(F.length("html").between(1, FIT_BYTES)), "page_id", sample_size, "html").select("html").collect()
    sent = session.sparkContext.broadcast(fit_pages([r.html for r in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch, "html", 2_000_000) if batch.num_rows else ():
                part = batch.slice(start, end - start)
                text = extract(part.column("html").to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(text), pa.array(map(len, text), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    chosen = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
