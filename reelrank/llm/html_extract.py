"""Main text of web pages by tag-path ratios.

Every block of text lies at the end of a path of tags from the root. For each
path of a page the text length and the punctuation of its blocks are summed
and divided by the number of blocks; the two ratios are smoothed along the
page, fused into one value, and paths under a threshold are no content. What
stays names the content root, whose blocks make up the text.

Elements that are boilerplate by their tag, or hidden, never count. Those that
are by their role, their id, a class name or a telling word of one, and forms,
count only if they hold the page's content; then they stand on their ratios.
The time is linear in the length of the page, however deep its elements lie.
Spark splits the pages over tasks; a page is read by one call of a helper.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags of the HTML standard and names in common use.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BOILERPLATE_TAGS = frozenset(
    "script style noscript template head title iframe object embed svg canvas audio video button select option "
    "input textarea nav menu header footer aside dialog noembed noframes".split())
BLOCK_TAGS = frozenset(
    "html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot "
    "tr td th caption figure figcaption address hr nav menu header footer aside form fieldset details summary dialog "
    "center noscript title script style".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT_TAGS = frozenset("article main".split())
# Some sites put a whole page into one.
FORMS = frozenset("form label".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs header footer cookie cookies consent notice notices popup modal newsletter subscribe share "
    "sharing social related recommended comment comments commentlist respond replies disqus widget pagination pager "
    "login signup toolbar masthead copyright".split())
# Words that tell of boilerplate in a compound name such as reader-comments; others may stand for a subject.
TELLING = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer cookie cookies consent notice popup modal newsletter subscribe share sharing comment comments commentlist disqus "
    "pagination pager login signup toolbar masthead".split())
WHOLE_SITE = frozenset("site global app".split())  # these make a header one of the site, not of the text
DENIED = frozenset("no not without with has hide hidden show is".split())
# Names of readers' replies, which may be longer than what they reply to.
REPLIES = frozenset("comment comments commentlist respond replies disqus".split())
# A start tag ends open elements of these kinds, up to the nearest of the others.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl menu table td th caption article section main body blockquote form".split())
WITHIN = {"li": LISTS, "dt": LISTS, "dd": LISTS, "tr": frozenset(["table"]), "td": frozenset(["table", "tr"]),
          "th": frozenset(["table", "tr"]), "option": frozenset(["select"])}
CELLS = frozenset("td th table caption button object".split())  # an open paragraph outside is left alone

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?])")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？；]")


@dataclass
class Element:
    """A block element of the page, with what its descendants inherit."""
    number: int
    tag: str
    parent: Element | None
    path: int
    article: Element | None
    main: Element | None


@dataclass
class Block:
    """A block's raw text nodes (text, whether in a link, the nearest named
    element around it) and the element it lies in."""
    element: Element | None
    parts: list[tuple[str, bool, Named | None]] = field(default_factory=list)
    linked: int = 0
    text: str = ""

    @property
    def content(self) -> bool:
        return self.element is not None and bool(self.element.article or self.element.main)


@dataclass(eq=False)
class Named:
    """An element that is boilerplate by its names, or a form."""
    replies: bool
    inside: bool  # an article or main
    parent: Named | None = None
    size: int = 0
    content: bool = False  # has text in an article or main
    stands: bool = True


def _tells(name: str) -> bool:
    """A name of the list, or a compound with a telling word."""
    words = re.split("[-_]+", name)
    if name in BOILERPLATE_NAMES or len(words) < 2 or words[0] in DENIED:
        return name in BOILERPLATE_NAMES
    return not TELLING.isdisjoint(words) or "header" in words and not WHOLE_SITE.isdisjoint(words)


def _boilerplate(tag: str, values: dict[str, str], inside_content: bool) -> bool | Named:
    if tag in BOILERPLATE_TAGS:
        return not (tag == "header" and inside_content)
    if tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in values or "display:none" in values.get("style", "").replace(" ", ""):
        return True
    names = [n for n in (*values.get("class", "").split(), values.get("id", "").strip()) if _tells(n)]
    if names or tag in FORMS or values.get("role", "").strip() in BOILERPLATE_ROLES:
        return Named(any(not REPLIES.isdisjoint(re.split("[-_]+", n)) for n in names), inside_content)
    return False


def _attributes(text: str) -> dict[str, str]:
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text) if text.strip() else ():
        values.setdefault(m[1].lower(), next((g for g in m.groups()[1:] if g is not None), "").lower())
    return values


def _without_named(found: list[Block], named: list[Named]) -> None:
    """Set the blocks' texts, without the parts in a named element that does
    not hold the page's content. It does if it has an article or main, when
    none lies outside and no more text does, or most of the page's text.
    ``named`` has outer elements before inner ones."""
    free = total = 0
    free_content = False
    for b in found:
        for text, _, e in b.parts:
            size = len(text.strip())
            total += size
            if e is None:
                free += size
                free_content |= b.content and size > 0
            else:
                e.size += size
                e.content |= b.content and size > 0
    for e in reversed(named):
        if e.parent is not None:
            e.parent.size += e.size
            e.parent.content |= e.content
    for e in named:
        most = 2 * e.size > total and not (e.replies and free)
        holds = e.content and not e.inside and e.size >= free
        e.stands = (e.inside or not free_content) and (most or holds) and (e.parent is None or e.parent.stands)
    for b in found:
        parts = [p for p in b.parts if p[2] is None or p[2].stands]
        b.linked = sum(len(text) for text, linked, _ in parts if linked)
        b.text = " ".join("".join(p[0] for p in parts).split())


def _tag_end(page: str, at: int, last_quote: dict[str, int]) -> int:
    """Index after the tag's closing bracket; brackets in quoted values don't count."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return len(page)
        quote = re.search(r"=\s*([\"'])", page[at:end])
        if not quote or last_quote[quote[1]] < at + quote.end():
            return end + 1
        close = page.find(quote[1], at + quote.end())
        at = close + 1
        if close < 0:
            return end + 1


@dataclass
class Open:
    """An open element and what holds inside it."""
    tag: str
    element: Element | None  # the nearest block element
    dropped: bool
    named: Named | None  # the nearest named element
    inside: bool  # an article or main
    linked: bool
    heading: bool
    header: bool


def blocks(page: str) -> list[Block]:
    """The blocks of text outside boilerplate, in page order."""
    out: list[Block] = []
    stack = [Open("", None, False, None, False, False, False, False)]
    named: list[Named] = []
    places: dict[str, list[int]] = {}  # of the open elements of each tag
    cells: list[int] = []  # places of the open CELLS
    paths: dict[tuple[int, str, str], int] = {}
    lower, last_quote = page.lower(), {q: page.rfind(q) for q in "\"'"}
    at = number = 0
    current: Block | None = None

    def text(raw: str) -> None:
        nonlocal current
        top = stack[-1]
        if not raw or top.dropped or top.header and not top.heading:
            return
        if current is None:
            current = Block(top.element)
            out.append(current)
        current.parts.append((entities.unescape(raw), top.linked, top.named))

    def pop_to(i: int) -> None:
        nonlocal current
        while len(stack) > i:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in CELLS:
                cells.pop()
        current = None

    def push(tag: str, attributes: str) -> None:
        nonlocal number
        number += 1
        up, values = stack[-1], _attributes(attributes)
        judged = _boilerplate(tag, values, up.inside)
        element = up.element
        if tag in BLOCK_TAGS:
            key = (element.path if element else 0, tag, " ".join(sorted(values.get("class", "").split())))
            element = Element(number, tag, element, paths.setdefault(key, len(paths) + 1), element.article if element else None,
                              element.main if element else None)
            if tag == "article" and element.article is None:
                element.article = element
            if tag == "main" and element.main is None:
                element.main = element
        if isinstance(judged, Named):
            judged.parent = up.named
            named.append(judged)
        places.setdefault(tag, []).append(len(stack))
        if tag in CELLS:
            cells.append(len(stack))
        stack.append(Open(tag, element, up.dropped or judged is True, judged if isinstance(judged, Named) else up.named,
                          up.inside or tag in CONTENT_TAGS, up.linked or tag == "a", up.heading or tag in HEADINGS,
                          up.header or tag == "header"))

    def nearest(tags: frozenset[str] | tuple[str, ...]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        if not m[2]:
            end = page.find("-->" if m[0] == "<!--" else ">", m.end())
            at = len(page) if end < 0 else end + (3 if m[0] == "<!--" else 1)
            continue
        tag, at = m[2].lower(), _tag_end(page, m.end(), last_quote)
        if m[1]:
            if tag in BLOCK_TAGS:
                current = None
            if places.get(tag):
                where = places[tag][-1]
                if tag in BLOCK_TAGS or where == len(stack) - 1:
                    block = current
                    pop_to(where)
                    current = None if tag in BLOCK_TAGS else block
                else:
                    _closed_early(stack, places, cells, named, where)
            continue
        if tag in BLOCK_TAGS:
            current = None
            if places.get("p") and places["p"][-1] > (cells[-1] if cells else 0):
                pop_to(places["p"][-1])
        if tag in ENDS:
            limit = nearest(WITHIN[tag])
            first = min((i for t in ENDS[tag] for i in _after(places.get(t, []), limit)), default=0)
            if first:
                pop_to(first)
        if tag == "br":
            text(" ")
        if tag in RAW:
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else _tag_end(page, end + 2, last_quote)
        elif tag not in VOID and page[at - 2:at] != "/>":
            push(tag, page[m.end():at - 1])
    _without_named(out, named)
    return [b for b in out if b.text]


def _after(open_places: list[int], limit: int) -> list[int]:
    """The first of the places beyond the limit, if any."""
    i = bisect.bisect_right(open_places, limit)
    return open_places[i:i + 1]


def _closed_early(stack: list[Open], places: dict[str, list[int]], cells: list[int], named: list[Named], where: int) -> None:
    """End an inline element before inline elements within it, which stay open
    and no longer inherit from it. Around an open block element the end tag
    counts for nothing; the block's own ends both."""
    gone, below, inner = stack[where], stack[where - 1], stack[where + 1:]
    if any(e.tag in BLOCK_TAGS for e in inner):
        return
    for e in stack[where:]:
        places[e.tag].pop()
        if e.tag in CELLS:
            cells.pop()
    del stack[where:]
    around = gone
    for e in inner:
        up = stack[-1]
        places[e.tag].append(len(stack))
        if e.tag in CELLS:
            cells.append(len(stack))
        own = up.named
        if e.named is not None and e.named is not around.named:  # a named one, from here on without the one that ended
            own = Named(e.named.replies, e.named.inside, up.named)
            named.append(own)
        around = e
        stack.append(Open(e.tag, e.element, e.dropped and (below.dropped or not gone.dropped), own, e.inside,
                          up.linked or e.tag == "a", up.heading, up.header))


def _smooth(x: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    here = slice(2, 2 + len(x))  # a page may be shorter than the kernel
    return np.convolve(x, kernel)[here] / np.convolve(np.ones(len(x)), kernel)[here]


def content(found: list[Block]) -> list[Block]:
    """The blocks of the content root, chosen by their paths' ratios."""
    inside = [b for b in found if b.content]
    pool = inside or found
    if not pool:
        return []
    paths, path = np.unique([b.element.path if b.element else 0 for b in pool], return_inverse=True)
    count = np.bincount(path, minlength=len(paths))
    sums = [np.bincount(path, weights=w, minlength=len(paths)) for w in (
        [len(b.text) for b in pool], [len(_PUNCTUATION.findall(b.text)) for b in pool], [min(b.linked, len(b.text)) for b in pool])]
    length, marks = (_smooth((s / count)[path]) for s in sums[:2])
    links = sums[2] / np.maximum(sums[0], 1)
    fused = length / max(length.max(), 1) * (1 + marks / max(marks.max(), 1)) * (1 - links[path])
    kept = [b for b, ok in zip(pool, fused >= min(fused.std(), fused.max()), strict=True) if ok]
    roots = {_root(b) for b in kept}
    known: dict[int, bool] = {0: 0 in roots}

    def under(e: Element | None) -> bool:
        """Whether a root is the element or around it (numbers grow downwards)."""
        way = []
        while e is not None and e.number not in known:
            way.append(e)
            e = e.parent
        answer = known[e.number if e else 0]
        for x in reversed(way):
            answer = known[x.number] = answer or x.number in roots
        return answer

    chosen = [under(b.element) for b in pool]
    for i in range(len(pool) - 2, -1, -1):  # headings directly before a root's blocks
        chosen[i] |= chosen[i + 1] and _heading(pool[i])
    # a list of links is part of an article, elsewhere it is navigation
    listing = {p for p in range(len(paths)) if links[p] > 0.5 and not sums[1][p]} if not inside else set()
    return [b for b, p, ok in zip(pool, path, chosen, strict=True) if ok and (p not in listing or _heading(b))]


def _heading(b: Block) -> bool:
    return b.element is not None and b.element.tag in HEADINGS


def _root(b: Block) -> int:
    """The enclosing article, else main, else the element around the block's."""
    e = b.element
    root = e and (e.article or e.main or e.parent or e)
    return root.number if root else 0


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in content(blocks(page or "")))


def extract(html: Column) -> Column:
    """Main text of each page: blocks in page order joined by a blank line,
    character references decoded, white space inside a block made one space. A
    null, empty or contentless page gives the empty string. Nothing is cut."""
    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return extracted(F.coalesce(html, F.lit("")))
