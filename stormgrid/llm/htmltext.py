"""Main text of web pages by the line-block distribution.

Markup is stripped into lines, one for each block-level element; a line's weight
is the length of its text, or 0 if it lies in an element that is no article text
(menus, forms, notices and the like, by name, role or class) or is mostly link
text. Weights are summed over windows of `WINDOW` lines. Where the sums rise from
zero the text surges, where they fall back to zero it dives; a stretch between a
surge and a dive whose highest sum reaches `SURGE` characters (or the highest
sum of the page, if that is less) is main text, and the lines in it with any
weight are kept in page order. Lines in an article or main element
weigh `FAVOUR` times their length (once if mostly link text), and stretches end
where such an element begins or ends; the threshold holds inside and outside alike.
An article or main element that its class, id or role marks, or that is hidden, is
no article text either.

Defined results: null, empty and text-free pages give an empty text; repeated
pages are treated alike, very long ones and broken markup in time linear in their length;
an empty table gives no rows; an unclosed comment, script or style runs to the end
of the page, an unclosed element to the end of the element around it; a "<" that
begins no tag is text; columns named text or n_chars are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stormgrid.llm.common import append_columns

WINDOW = 3
SURGE = 80
#: Weight of a character in an article or main element; 1 elsewhere.
FAVOUR = 4

#: Elements that begin a new line, that hold no article text, that hold no text at all, that are never closed.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = frozenset("nav footer aside form button select menu dialog head iframe object svg canvas audio video label input fieldset".split())
RAW = "script|style|noscript|template|textarea|title|xmp"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark what is no article text.
MARKS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "notification disclaimer alert sidebar aside complementary menu nav navbar navigation breadcrumb breadcrumbs footer contentinfo header masthead topbar "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login search form popup modal overlay dialog widget toolbar pagination pager toc hidden".split()
)

NAME = re.compile(r"<(/?)([a-z][a-z0-9:-]*)", re.IGNORECASE)
RAW_START = re.compile(rf"<({RAW})\b", re.IGNORECASE)
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW.split("|")}
STOP = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)


def is_outside(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds no article text; the header of an article does."""
    if name in OUTSIDE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body"):
        return False
    if HIDDEN.search(attributes):
        return True
    words = {w for m in ATTRIBUTE.finditer(attributes) for w in re.split(r"[^a-z0-9]+", (m[2] or m[3] or m[4] or "").lower())}
    return bool(words & (MARKS - {"header"} if in_article else MARKS))


def tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, whether closing, name and attributes of every token; no name for comments, declarations and elements without markup.

    In time linear in the page: what is known not to follow is not looked for again.
    """
    last = {c: page.rfind(c) for c in "\"'>"}
    dead: set[int] = set()  # quotes from which no tag ends

    def tag_end(at: int) -> int:
        """Place after the first ">" that is in no quotes; 0 if there is none."""
        passed = []
        while at <= last[">"]:
            at = STOP.search(page, at).start()
            quote = page[at]
            if quote == ">":
                return at + 1
            passed.append(at)
            if at in dead or at == last[quote]:
                break
            at = page.find(quote, at + 1) + 1
        dead.update(passed)
        return 0

    at = page.find("<")
    while at >= 0:
        end, closing, name, attributes = 0, False, "", ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            end = len(page) if end == 2 else end
        elif at < last[">"]:
            raw = RAW_START.match(page, at)
            if raw:
                found = RAW_END[raw[1].lower()].search(page, page.find(">", raw.end()) + 1)
                end = found.end() if found else len(page)
            elif page[at + 1] in "!?":
                end = page.find(">", at) + 1
            elif named := NAME.match(page, at):
                end = tag_end(named.end())
                closing, name, attributes = bool(named[1]), named[2].lower(), page[named.end() : end - 1]
        if end:
            yield at, end, closing, name, attributes
        at = page.find("<", end or at + 1)


class Open:
    """The elements that are open, with what must be known of them at every token."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool]] = []  # name, outside, article
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.outside = self.article = self.links = 0

    def push(self, name: str, outside: bool) -> None:
        article = name in ("article", "main")
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, outside, article))
        self._count(name, outside, article, 1)

    def cut(self, depth: int) -> None:
        """Closes the element at `depth` and all inside it."""
        while len(self.stack) > depth:
            name, outside, article = self.stack.pop()
            self.places[name].pop()
            if name in BLOCKS:
                self.blocks.pop()
            self._count(name, outside, article, -1)

    def _count(self, name: str, outside: bool, article: bool, by: int) -> None:
        self.outside += by * outside
        self.article += by * article
        self.links += by * (name == "a")

    def depth(self, name: str) -> int:
        """Where the innermost element of the name is, -1 without one."""
        places = self.places.get(name)
        return places[-1] if places else -1


def lines_of(page: str) -> list[tuple[str, bool, int, bool]]:
    """Lines of a page in order: text, whether it may be article text, characters inside links, whether in an article or main element."""
    lines: list[tuple[str, bool, int, bool]] = []
    opened = Open()
    parts: list[str] = []
    linked = 0

    def end_line() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        lines.append((text, not opened.outside, linked, opened.article > 0))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = unescape(raw)
        parts.append(text)
        if opened.links:
            linked += len(text.strip())

    at = 0
    for start, end, closing, name, attributes in tokens(page):
        if start > at:
            add(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        block = name in BLOCKS or name in OUTSIDE
        if not closing and is_outside(name, attributes, opened.article > 0):
            block = True
        if block:
            end_line()
        if name in VOID:
            continue
        if closing:
            depth = opened.depth(name)
            # An element closes what is open inside it, but an inline one no block around it.
            if depth >= 0 and (block or not opened.blocks or opened.blocks[-1] <= depth):
                if not block and opened.stack[depth][1]:
                    end_line()
                opened.cut(depth)
        else:
            # A paragraph ends an open one.
            if name == "p" and opened.blocks and opened.stack[opened.blocks[-1]][0] == "p":
                opened.cut(opened.blocks[-1])
            opened.push(name, is_outside(name, attributes, opened.article > 0))
    if at < len(page):
        add(page[at:])
    end_line()
    return lines


def weight_of(text: str, may: bool, linked: int, inside: bool) -> int:
    """Weight of a line; one of mostly link text is not favoured inside an article, and weighs nothing outside."""
    if not may:
        return 0
    plain = 2 * linked <= len(text)
    return len(text) * ((FAVOUR if plain else 1) if inside else plain)


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    lines = lines_of(page)
    weights = [weight_of(*line) for line in lines]
    sums = [0] * len(lines)
    runs: list[tuple[int, int]] = []  # lines in a row that are all inside an article or main element, or all outside
    for i in range(len(lines)):
        if i and lines[i][3] == lines[i - 1][3]:
            runs[-1] = (runs[-1][0], i + 1)
        else:
            runs.append((i, i + 1))
    for first, last in runs:
        total = sum(weights[first : min(first + window - 1, last)])
        for i in range(first, last):  # the window of line i and those after it
            total += weights[i + window - 1] if i + window - 1 < last else 0
            sums[i] = total
            total -= weights[i]
    least = max(min(surge, max(sums, default=0)), 1)
    kept: list[str] = []
    for first, last in runs:
        at = first
        while at < last:
            if not sums[at]:
                at += 1
                continue
            start = at
            while at < last and sums[at]:
                at += 1
            if max(sums[start:at]) >= least:
                kept += [lines[i][0] for i in range(start, at) if weights[i]]
    return "\n\n".join(kept)


def extract(pages: DataFrame, html: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """All columns of `pages` but the markup, with `text` and `n_chars` (code points)."""
    def make():
        def work(texts):
            found = [main_text(t.decode("utf-8", "replace"), window, surge) for t in texts]
            return found, [len(t) for t in found]

        return work

    return append_columns(pages, html, make, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], drop=(html,))
