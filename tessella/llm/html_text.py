"""Main text of web pages by line-block distribution (operator 10).

The page is read once by the states of an HTML tokenizer and becomes lines: one for each block
element, with markup, scripts, styles and comments gone. A line weighs its characters outside links less those
inside links; a heading weighs all of its characters. Weights are summed over sliding windows of lines, each line's
own and its neighbours'. The text surges where a windowed sum rises over a ``SHARE``-th of the
page's highest and dives where it falls to that or below. What lies between surge and dive is kept, links and
short lines too, but for lines of links at its ends. No region is chosen over another: all that surge stay,
whatever their size, and no tag or name tells where the article is.

Markup lowers weights. Lines of menus, footers, asides, forms and the like, and of elements whose class, id or
role tells of furniture, have no weight and no place in the windows, so a text goes on behind what
interrupts it; so has furniture within a line. A name with other words in it (``top-story``) halves the weight only. An
element that holds most of the page's text is never furniture by its name or as a form: over half of the text where the name
has words beside those of furniture (``related-content``), over three quarters of it, and ``FEW`` lines, where it has none.
Names of reader comments are no less of furniture for that, as comments may well be longer than the article.

Cases: null or empty html gives an empty text, and so does a page without a surge (one of links only); unclosed
tags end with their parent; a tag that the page ends in is text; a quote that never closes ends with
its tag; regions of equal height are all kept; rows that repeat are answered row by row; an empty table gives an empty
result. Very long pages are read whole, in time proportional to their length. Other columns, whatever their
names, play no part.
"""

from __future__ import annotations

import html
import re
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import map_arrow, small_batches

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_GAP, _NAME, _EQUALS, _BARE = re.compile(r"[\s/]*"), re.compile(r"=?[^\s/>=]*"), re.compile(r"\s*=\s*"), re.compile(r"[^\s>]*")
_RAW = ("script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
_BLOCK = {
    "html", "body", "head", "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr",
    "caption", "section", "article", "main", "nav", "header", "footer", "aside", "form", "fieldset", "figure", "figcaption", "blockquote", "pre", "address",
    "details", "summary", "dialog", "menu", "hr", "option", "select", "button", "center", "legend",
}
_SPACE = {"br", "td", "th"}
_HEADINGS = {"h1", "h2"}
_UNSEEN = {"head", "noscript", "template", "svg"}
_FIRM = {"nav", "footer", "aside", "button", "select", "menu", "dialog"} | _UNSEEN  # never the frame of a page's text
_LOOSE = {"form", "fieldset"}
_NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
_NOISE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "promo", "promotion", "sponsor", "sponsored",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "popup", "modal", "overlay", "alert", "newsletter", "subscribe", "subscription", "signup",
    "paywall", "sidebar", "aside", "menu", "menubar", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "masthead", "topbar", "toolbar", "footer", "colophon",
    "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "related", "recommended", "recommendations", "share", "sharing", "social",
    "widget", "widgets", "login", "pagination", "pager", "copyright", "skip", "hidden", "form", "disclaimer", "trending",
}
_HEAD_WORDS = {"header", "head", "top"}  # outside an article
_COMMENT_WORDS = {"comment", "comments", "commentlist", "reply", "replies", "respond", "disqus"}
_NUMBERED = _COMMENT_WORDS | {"ad", "ads", "adv", "advert", "banner", "widget", "sidebar", "notice", "popup"}
_PLAIN_WORDS = {
    "box", "block", "list", "item", "items", "wrap", "wrapper", "container", "content", "area", "section", "row", "col", "column", "inner", "outer", "left", "right", "bottom",
    "main", "page", "group", "button", "buttons", "btn", "link", "links", "bar", "panel", "icon", "icons", "text", "title", "body", "post", "posts", "article", "articles", "site",
    "global", "primary", "secondary", "mobile", "desktop", "unit", "slot", "zone", "thread", "form", "field", "input", "label", "image", "media", "big", "small", "large",
}
_ABOUT = {"no", "has", "have", "with", "without", "hide", "show", "is", "js"}  # before a word that tells of another element: "has-sidebar"
_SCOPES = {"article", "main"}
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
_IN_LINE = {"option", "select", "button"}  # blocks that may stand within a paragraph
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WINDOW, SHARE = 3, 1000
MAYBE, MIXED, NAMED, COMMENTS, LOOSE, FIRM = 1, 2, 3, 4, 5, 6  # what tells of furniture
FEW = 3  # lines of an element of a furniture name alone, or of a form, that may hold most of the text


def _name_tells(name: str, inside: bool) -> int:
    words = [w.lower() for w in _WORDS.findall(name)]
    noise = [w in _NOISE_WORDS or (not inside and w in _HEAD_WORDS) for w in words]
    noise = [x and (k == 0 or words[k - 1] not in _ABOUT) for k, x in enumerate(noise)]
    if not any(noise):
        return 0
    if all(w in _HEAD_WORDS for w, x in zip(words, noise) if x) and {"article", "post", "content", "main"} & set(words):
        return 0  # the article's own header
    numbered = any(w in _NUMBERED for w in words)
    if not all(x or w in _PLAIN_WORDS or (numbered and w.isdigit()) for w, x in zip(words, noise)):
        return MAYBE
    if any(w in _COMMENT_WORDS for w in words):
        return COMMENTS
    return NAMED if all(x or w.isdigit() for w, x in zip(words, noise)) else MIXED


def _furniture(tag: str, a: dict[str, str], inside: bool) -> int:
    """What tells that an element is furniture, by its tag, role, class or id; ``inside``: of an article, whose own header is none."""
    if tag in _FIRM:
        return FIRM
    found = LOOSE if tag in _LOOSE or (tag == "header" and not inside) else 0
    if not a or tag in ("html", "body", "main"):
        return found
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in _NOISE_ROLES or re.search(r"display\s*:\s*none", a.get("style", "")):
        found = max(found, NAMED)
    return max([found, *(_name_tells(name, inside) for name in f"{a.get('class', '')} {a.get('id', '')}".split())])


class Lines:
    """The lines of a page: texts, how much of them is linked, and the elements they stand in."""

    def __init__(self, page: str):
        self.text: list[str] = []
        self.linked: list[int] = []
        self.at: list[int] = []
        self.parent, self.tells, self.heading = [-1], [0], [False]
        self._read(page)

    def _read(self, page: str) -> None:
        self._page, self._last, self._loose = page, {q: page.rfind(q) for q in "\"'>"}, False
        stack: list[tuple[str, int]] = [("", 0)]
        blocks = [0]  # places of block elements in the stack
        opened: dict[str, list[int]] = {"a": []}  # places in the stack, by tag
        buffer: list[str] = []
        linked, i, n, inside, muted = 0, 0, len(page), 0, 0

        def flush() -> None:
            nonlocal linked
            if buffer and (line := " ".join(html.unescape("".join(buffer)).split())):
                self.text.append(line)
                self.linked.append(min(linked, len(line)))
                self.at.append(stack[-1][1])
            buffer.clear()
            linked = 0

        def close(to: int) -> None:
            nonlocal inside, muted
            for tag, k in stack[to:]:
                if not tag:  # closed before, below a block that went on
                    continue
                opened[tag].pop()
                muted -= self.tells[k] > MAYBE and tag not in _BLOCK
                inside -= tag in _SCOPES
            del stack[to:]
            while blocks[-1] >= to:
                blocks.pop()

        while i < n:
            j = page.find("<", i)
            if j < 0:
                j = n
            if j > i and not muted:
                buffer.append(page[i:j])
                linked += (j - i) * bool(opened["a"])
            if j == n:
                break
            if page.startswith(("<!", "<?"), j) or page.startswith("</", j) and not page[j + 2 : j + 3].isalpha():
                end = page.find("-->" if page.startswith("<!--", j) else ">", j)
                i = n if end < 0 else end + (3 if page[end] == "-" else 1)
                continue
            m = _TAG.match(page, j)
            end, attributes = self._attributes(m.end()) if m and j < self._last[">"] else (-1, {})
            if end < 0:
                buffer.append("" if muted else "<")
                i = j + 1
                continue
            i, tag = end, m[2].lower()
            if m[1]:
                if tag in _BLOCK:
                    flush()
                elif tag in _SPACE:
                    buffer.append(" ")
                if opened.get(tag):
                    to = opened[tag][-1]
                    if tag in _BLOCK or blocks[-1] < to:
                        close(to)
                    else:  # the end of an element within a line ends no block
                        opened[tag].pop()
                        muted -= self.tells[stack[to][1]] > MAYBE
                        stack[to] = ("", stack[to][1])
                continue
            if tag in _RAW_END:
                found = _RAW_END[tag].search(page, i)
                end = page.find(">", found.end()) if found else -1
                i = n if end < 0 else end + 1
                continue
            if tag in _BLOCK:
                flush()
                near = stack[blocks[-1]][0]
                if near in _ENDS.get(tag, ()) or near == "p" and tag not in _IN_LINE:
                    close(blocks[-1])
            elif tag in _SPACE:
                buffer.append(" ")
            if tag in _VOID or page[i - 2] == "/" and tag not in _BLOCK:
                continue
            self.parent.append(stack[-1][1])
            self.tells.append(_furniture(tag, attributes, inside > 0))
            self.heading.append(tag in _HEADINGS)
            if tag in _BLOCK:
                blocks.append(len(stack))
            opened.setdefault(tag, []).append(len(stack))
            stack.append((tag, len(self.parent) - 1))
            muted += self.tells[-1] > MAYBE and tag not in _BLOCK  # furniture within a line
            inside += tag in _SCOPES
        flush()

    def _attributes(self, i: int) -> tuple[int, dict[str, str]]:
        """Behind the tag that goes on at ``i``, and its attributes; -1 if the page ends before."""
        page, found, n = self._page, {}, len(self._page)
        if self._loose:  # the page ended in a tag: from then on a tag ends at the next >
            end = page.find(">", i)
            return (end + 1 if end >= 0 else -1), {}
        start = i
        while True:
            i = _GAP.match(page, i).end()
            if i >= n:
                self._loose = True
                return self._attributes(start)
            if page[i] == ">":
                return i + 1, found
            m = _NAME.match(page, i)
            name, value, i = m[0].lower(), "", m.end()
            if m := _EQUALS.match(page, i):
                i = m.end()
                quote = page[i : i + 1]
                if quote in ("'", '"') and i < self._last[quote]:
                    end = page.find(quote, i + 1)
                    value, i = page[i + 1 : end], end + 1
                else:
                    m = _BARE.match(page, i)
                    value, i = m[0], m.end()
            found.setdefault(name, html.unescape(value))

    def factors(self) -> np.ndarray:
        """What markup leaves of each line's weight: 1, less for names that may tell of furniture, 0 for furniture."""
        n = len(self.parent)
        firm, held, lines = [False] * n, [0] * n, [0] * n
        for k in range(1, n):
            firm[k] = firm[self.parent[k]] or self.tells[k] == FIRM
        for at, text, linked in zip(self.at, self.text, self.linked):
            held[at] += (len(text) - linked) * (not firm[at])
            lines[at] += not firm[at]
        for k in range(n - 1, 0, -1):
            held[self.parent[k]] += held[k]
            lines[self.parent[k]] += lines[k]
        factor = [1.0] * n
        for k in range(1, n):
            tells, half, most = self.tells[k], 2 * held[k] > held[0], 4 * held[k] > 3 * held[0] and lines[k] >= FEW
            if tells == MIXED and half or tells == LOOSE and half and lines[k] >= FEW or tells == NAMED and most:
                tells = MAYBE
            factor[k] = factor[self.parent[k]] * (1.0, 0.5, 0.0)[min(tells, MIXED)]
        return np.array([factor[k] for k in self.at])

    def weights(self) -> np.ndarray:
        """Of each line, before markup: its characters outside links less those inside."""
        return np.array([len(t) if self.heading[k] else len(t) - 2 * linked for t, linked, k in zip(self.text, self.linked, self.at)], np.float64)


def windowed(weight: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The sum over each line and its neighbours, ``window`` lines around it (one more ahead where that is even)."""
    n, back = len(weight), (window - 1) // 2
    total = np.concatenate([[0], np.cumsum(weight)])
    return total[np.minimum(np.arange(n) + window - back, n)] - total[np.maximum(np.arange(n) - back, 0)]


def regions(weight: np.ndarray, window: int = WINDOW, share: float = SHARE) -> list[tuple[int, int]]:
    """Half-open ranges of lines from each surge of the windowed sum to its dive, without lines at their ends that weigh nothing or less."""
    if not len(weight):
        return []
    block = windowed(weight, window)
    top = block.max()
    if top <= 0:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (block * share > top).astype(np.int8), [0]]))).reshape(-1, 2)
    out = []
    for a, z in edges.tolist():
        held = np.flatnonzero(weight[a:z] > 0)
        if len(held):
            out.append((a + int(held[0]), a + int(held[-1]) + 1))
    return out


def chosen_lines(lines: Lines, window: int = WINDOW, share: float = SHARE) -> list[int]:
    """Places of the lines of the main text."""
    factor = lines.factors()
    seen = np.flatnonzero(factor)
    return [int(k) for a, z in regions((lines.weights() * factor)[seen], window, share) for k in seen[a:z]]


def main_text(page: str | None, window: int = WINDOW, share: float = SHARE) -> str:
    """The main text: blocks in page order, joined by a blank line; empty if there is none."""
    if not page:
        return ""
    lines = Lines(page)
    return "\n\n".join(lines.text[k] for k in chosen_lines(lines, window, share))


def extract_pages(pages: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``page_id, url, text, n_chars``, one row per page."""
    small_batches(pages.sparkSession)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x, window, share) for x in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

        return step

    return map_arrow(
        pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")),
        make, "page_id long, url string, text string, n_chars long",
    )
