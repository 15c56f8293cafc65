"""Main text of web pages by composite text density.

For every node of the DOM: characters per tag, weighted by how few of its characters and tags are
links, with the body's share of link text in the base of the logarithm. A node's density sum adds
up its children. The lowest density on the way from the node with the largest sum up to the body
is the threshold; below every node that reaches it, the subtree with the largest sum is content.

Parts that are no article by their element, role or class name (menus, footers, adverts, forms,
reader comments) count as text in the statistics but add to no sum and are never content. Class
names and ids count as a whole or by the parts that say what a thing is (``site-footer``,
``adSlot``). Names, roles and elements such as ``form`` or ``aside`` mark a part only where it
does not wrap the content.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .rows import append_columns

# Element names.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
NOISE_TAGS = {
    "head", "button", "select", "object", "embed", "svg", "canvas", "audio", "video", "map",
} | RAW
# Noise unless they wrap the content: boxes, which some pages put around all they have, and frames,
# which hold text of their own and so must also hold an article or main.
BOX_TAGS = {"form", "aside", "fieldset", "dialog"}
FRAME_TAGS = {"nav", "footer", "header", "menu"}
BOX_ROLES = {"alert", "alertdialog", "complementary", "dialog", "form", "search"}
FRAME_ROLES = {"banner", "contentinfo", "menu", "menubar", "navigation", "toolbar"}
NOISE_NAMES = {
    "ad", "ads", "adsbygoogle", "advert", "adverts", "advertisement", "advertising", "alert",
    "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "overlay", "pager", "pagination", "popup", "promo", "promotion",
    "related", "replies", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget",
}
# Of a name in parts: the last part says what the thing is, or the first one does and the last is
# a word for any part of a page. Other first or last parts, or a word that denies, say nothing.
LAST_PARTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookies", "disqus", "footer", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "replies",
    "sidebar", "signup", "sponsor", "subscribe",
}
ANY_PARTS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "column", "container",
    "content", "form", "group", "holder", "icons", "inner", "item", "items", "left", "link",
    "links", "list", "message", "outer", "panel", "right", "row", "section", "slot", "text",
    "thread", "top", "unit", "widget", "widgets", "wrap", "wrapper", "zone",
}
DENIALS = {"has", "hide", "is", "no", "non", "not", "off", "with", "without"}
SITE_HEADERS = {"site", "page", "top", "global"}
# Readers' comments can be longer than the article.
READER_NAMES = {"comment", "comments", "disqus", "replies"}
# Elements that hold the content: their ancestors' names do not make them noise.
LANDMARKS = {"article", "main", "h1"}
# Elements of the page's frame: their class names do not make them noise.
FRAME = {"html", "body", "article", "main"}
# A start tag of the key closes an open element of the set, up to the barrier.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*\Z",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""", re.DOTALL
)


_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(maxsize=1 << 16)
def noise_name(name: str) -> str | None:
    """The word by which a class name or id tells a part that is no article."""
    if (whole := name.lower()) in NOISE_NAMES or whole == "header":
        return whole
    parts = [p.lower() for p in _PARTS.findall(name)]
    if len(parts) < 2 or not DENIALS.isdisjoint(parts):
        return None
    first, last = parts[0], parts[-1]
    if last in LAST_PARTS or (last == "header" and first in SITE_HEADERS):
        return last
    return first if first in NOISE_NAMES and last in ANY_PARTS else None


class Dom:
    """Nodes in page order as parallel lists; ``events`` are texts and block borders."""

    def __init__(self, page: str):
        self.tags, self.parents, self.noise = ["#page"], [-1], [False]
        # What marks noise unless the node is a wrapper: whether a box (or a frame), and names.
        self.boxes: dict[int, bool] = {}
        self.named: dict[int, set[str]] = {}
        self.events: list[tuple[int, str | None]] = []
        self.open = [0]
        self.opened: Counter[str] = Counter()  # open elements by tag, to spare most walks up
        at = 0
        while match := _MARKUP.search(page, at):
            self._text(page[at : match.start()])
            at = match.end()
            tag = (match["tag"] or "").lower()
            if match["end"]:
                self._close(tag)
            elif tag:
                self._start(tag, match["rest"])
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
                    at = end.start() if end else len(page)
        self._text(page[at:])
        if self.boxes:
            self._judge_boxes()
        if self.named:
            self._judge_names()

    def _text(self, text: str) -> None:
        if text:
            self.events.append((self.open[-1], html.unescape(text)))

    def _border(self, node: int, tag: str) -> None:
        if tag in BLOCK:
            self.events.append((node, None))

    def _pop(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.open.pop()
            self.opened[self.tags[node]] -= 1
            self._border(node, self.tags[node])

    def _close(self, tag: str) -> None:
        if not self.opened[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]] == tag:
                self._pop(depth)
                return

    def _start(self, tag: str, rest: str) -> None:
        if tag in ("body", "html") and self.opened[tag]:
            return
        inner, barrier = CLOSES.get(tag, ({"p"} if tag in BLOCK else set(), {"table", "button"}))
        walk = any(self.opened[name] for name in inner)
        for depth in range(len(self.open) - 1, 0, -1) if walk else ():
            name = self.tags[self.open[depth]]
            if name in inner:
                self._pop(depth)
                break
            if name in barrier:
                break
        if tag == "body":
            self._close("head")
        parent, node = self.open[-1], len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.noise.append(self.noise[parent] or self._is_noise(node, tag, rest))
        self._border(node, tag)
        if tag == "br":
            self.events.append((parent, " "))
        if tag not in VOID and not (rest.rstrip().endswith("/") and tag not in BLOCK):
            self.open.append(node)
            self.opened[tag] += 1

    def _is_noise(self, node: int, tag: str, rest: str) -> bool:
        """By element or attribute; boxes, roles and names are noted, to be judged on the whole page."""
        if tag in NOISE_TAGS:
            return True
        in_article = bool(self.opened["article"] or self.opened["main"])
        if tag in BOX_TAGS or (tag in FRAME_TAGS and not (tag == "header" and in_article)):
            self.boxes[node] = tag in BOX_TAGS
        if not rest.strip() or tag in FRAME:
            return False
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
        words = (n for key in ("class", "id") for n in given.get(key, "").split())
        names = {found for n in words if (found := noise_name(n))}
        if found := names - {"header"} if in_article else names:
            self.named[node] = found
        role = given.get("role", "").lower()
        if role in BOX_ROLES | FRAME_ROLES:
            self.boxes.setdefault(node, role in BOX_ROLES)
        return "hidden" in given or "display:none" in given.get("style", "").replace(" ", "").lower()

    def _weighed(self) -> tuple[list[bool], list[bool], list[int]]:
        """Whether each node holds a landmark, whether an article or main, and its characters
        outside links and noise.

        An article inside another one is no landmark: it may be a reader's comment.
        """
        n = len(self.tags)
        inside, linked = [False] * n, [False] * n
        holds, frames, plain = [False] * n, [False] * n, [0] * n
        for i in range(1, n):
            up = self.parents[i]
            linked[i] = linked[up] or self.tags[i] == "a"
            inside[i] = inside[up] or self.tags[up] == "article"
            holds[i] = self.tags[i] in LANDMARKS and not self.noise[i] and not inside[i]
            frames[i] = holds[i] and self.tags[i] != "h1"
        for node, text in self.events:
            if text is not None and not self.noise[node] and not linked[node]:
                plain[node] += len("".join(text.split()))
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            holds[up] |= holds[i]
            frames[up] |= frames[i]
            plain[up] += plain[i]
        return holds, frames, plain

    def _judge_boxes(self) -> None:
        """A box is noise unless it has most of the text without links and, where the page has an
        article or main, holds one; a frame must hold one on any page."""
        _, frames, plain = self._weighed()
        for i in range(1, len(self.tags)):
            if i in self.boxes:
                most = 2 * plain[i] > plain[0]
                wrapper = most and (frames[i] or (self.boxes[i] and not frames[0]))
                self.noise[i] |= not wrapper
            self.noise[i] |= self.noise[self.parents[i]]

    def _judge_names(self) -> None:
        """Names make noise of what holds no landmark, nor most of the text without links.

        Where the page has an article or main, an advert can be the longer text, so the amount
        says nothing.
        """
        holds, frames, plain = self._weighed()
        for i in range(1, len(self.tags)):
            if found := self.named.get(i):
                elsewhere = frames[0] or bool(found & READER_NAMES and holds[0])
                most = 2 * plain[i] > plain[0] and not elsewhere
                self.noise[i] |= not (holds[i] or most)
            self.noise[i] |= self.noise[self.parents[i]]


def densities(dom: Dom, body: int) -> list[float]:
    """Composite text density of every node."""
    n = len(dom.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = dom.tags[i] == "a" or linked[dom.parents[i]]
    for node, text in dom.events:
        if text is not None and dom.tags[node] not in RAW:
            size = len("".join(text.split()))
            chars[node] += size
            link_chars[node] += size * linked[node]
    for i in range(n - 1, 0, -1):
        up = dom.parents[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        link_tags[up] += link_tags[i] + (dom.tags[i] == "a")
    share = link_chars[body] / max(1, chars[body])
    out = []
    for c, t, lc, lt in zip(chars, tags, link_chars, link_tags, strict=True):
        t = max(1, t)
        base = math.log(math.log(c / max(1, c - lc) * lc + share * c + math.e)) if c else 0
        inner = math.log(c / max(1, lc) * t / max(1, lt)) if c else 0
        # Without any link on the page the base is 1: plain characters per tag.
        out.append(c / t * (inner / base if base > 1e-12 else 1.0))
    return out


def content_nodes(dom: Dom) -> list[bool]:
    """Which nodes lie in a selected subtree."""
    n = len(dom.tags)
    body = next((i for i, t in enumerate(dom.tags) if t == "body"), 0)
    density = densities(dom, body)
    # Inline markup counts as tags, but only blocks, and what holds blocks, take part in sums.
    block = [i == body or t in BLOCK for i, t in enumerate(dom.tags)]
    for i in range(n - 1, 0, -1):
        block[dom.parents[i]] |= block[i]
    part = [b and not noisy for b, noisy in zip(block, dom.noise, strict=True)]
    sums, best, leaf = [0.0] * n, list(range(n)), [True] * n
    for i in range(n - 1, 0, -1):
        if part[i]:
            sums[dom.parents[i]] += density[i]
            leaf[dom.parents[i]] = False
    # A block without blocks stands for its own density; at equal sums the upper one wins.
    sums = [density[i] if leaf[i] else s for i, s in enumerate(sums)]
    for i in range(n - 1, 0, -1):
        up = dom.parents[i]
        if part[i] and sums[best[i]] > sums[best[up]]:
            best[up] = best[i]
    node, threshold = best[body], math.inf
    while node >= body:
        threshold = min(threshold, density[node])
        node = dom.parents[node]
    chosen = [False] * n
    for i in range(body, n):
        if part[i] and density[i] > 0 and density[i] >= threshold:
            chosen[best[i]] = True
    for i in range(1, n):
        chosen[i] = (chosen[i] or chosen[dom.parents[i]]) and not dom.noise[i]
    return chosen


def main_text(page: str | None) -> str:
    """Blocks of the content in page order, one to a line."""
    if not page:
        return ""
    dom = Dom(page)
    chosen = content_nodes(dom)
    blocks, run = [], []
    for node, text in [*dom.events, (0, None)]:
        if text is not None:
            if chosen[node]:
                run.append(text)
        elif run:
            if block := " ".join("".join(run).split()):
                blocks.append(block)
            run = []
    return "\n".join(blocks)


def extract(pages: DataFrame, *, html_col: str = "html", keep_html: bool = False) -> DataFrame:
    """``pages`` with text and n_chars (code points).

    A null, empty or text-free page has an empty text. Rows are read one by one; columns named
    text and n_chars are replaced.
    """

    def make():
        def work(batch: pa.RecordBatch) -> list:
            texts = [main_text(p) for p in batch.column(html_col).to_pylist()]
            return [texts, list(map(len, texts))]

        return work

    return append_columns(
        pages, "text string, n_chars bigint", make, drop=() if keep_html else (html_col,)
    )
