"""The main text of web pages by tree scoring.

A page is read into its elements; menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments, told by tag, role or class, are
left out with all inside. Each remaining block of text passes points to its
ancestors: one, one per comma and up to three for length, less the share of its
text that is links; the parent gets all, the grandparent half, further ancestors
less. Of the containers, each less the share of links in it, the best is taken,
or the article around it, together with those siblings that look like text too:
headings, lists, what scores, sentences before it, and the page's title also from further up. Inside a
``main`` without an article all goes that isn't mostly links, in the best container as beside it.

Names are a guess, so an element left out by its class or id alone comes back if
the page's articles are all in such elements and one of them holds more than what
is left, or if less than a tenth of the text is left: first elements with half of
the text, then all. Comments come back only where a page has nothing else. A name
that tells of something's presence or absence (has-sidebar) says nothing of the
element, and a header in an article is part of it, by tag as by class.

White space in a block becomes one space, blocks are joined by line ends, in
page order. Null and empty pages, and pages without text, give the empty text;
cut-off pages are read as far as they go; repeated rows give repeated rows; an
empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from prosestat.llm.shared import ship

ATTRIBUTES = r"[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*"
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)(" + ATTRIBUTES + r"(?=>|\Z)|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")

# Elements of HTML by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object".split())
DROPPED = frozenset("nav footer aside form button select dialog menu audio video canvas".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th figcaption caption summary address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
BOILERPLATE = frozenset((
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted "
    "recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget").split())
LISTS = frozenset("ul ol dl table".split())
ARTICLES = frozenset(("article", "main"))
STATES = frozenset("has no not with without".split())
HEADERS = frozenset("header masthead".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: What is less than this share of the text is next to nothing.
LEAST_LEFT = 0.1


class Element:
    __slots__ = ("tag", "parent", "number", "hard", "names", "dropped", "score", "chars", "linked", "inside", "lost")

    def __init__(self, tag: str, parent: Element | None, number: int = 0, hard: bool = False, names: frozenset[str] = frozenset(), lifted: bool = False):
        self.tag, self.parent, self.number = tag, parent, number
        self.hard = hard or bool(parent and parent.hard)
        self.names = names  # of boilerplate, in its class or id
        self.dropped = self.hard or bool(names) and not lifted or bool(parent and parent.dropped)
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.inside = tag in ARTICLES or bool(parent and parent.inside)
        self.lost = 0  # characters inside that are left out by names alone

    def line(self) -> list[Element]:
        """The element and its ancestors."""
        out = [self]
        while out[-1].parent:
            out.append(out[-1].parent)
        return out


def _named(value: str, inside: bool) -> set[str]:
    """The names of boilerplate in a class or id; ``inside``: of an element in an article."""
    out = set()
    for name in value.split():
        for part in re.split(r"[_-]+", name):
            if part in STATES:
                break  # has-sidebar, no-sidebar
            if part in BOILERPLATE and not (inside and part in HEADERS):
                out.add(part)
    return out


def _left_out(tag: str, attributes: str, parent: Element) -> tuple[bool, frozenset[str]]:
    """Whether an element is boilerplate by its tag, role or style, and its names of boilerplate."""
    if tag in DROPPED or tag == "header" and not parent.inside:
        return True, frozenset()
    names: set[str] = set()
    if not attributes or tag in ("html", "body") or tag in ARTICLES:
        return False, frozenset()
    for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if hidden or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return True, frozenset()
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True, frozenset()
        if name in ("class", "id"):
            names |= _named(value, parent.inside)
    return False, frozenset(names)


def blocks(html: str, lifted: frozenset[int] = frozenset()) -> tuple[list[tuple[Element, str, int]], list[Element], list[Element]]:
    """(element, text, characters in links) of each block that isn't left out, in page order; the elements left out by names alone; the articles.

    ``lifted`` has the numbers of elements whose names don't count.
    """
    root = Element("html", None)
    stack, out, text, linked, links, at, count = [root], [], [], 0, 0, 0, 0
    named, articles = [], []

    def flush() -> None:
        nonlocal linked
        if text:
            own = next(e for e in reversed(stack) if e.tag not in INLINE)
            if not own.dropped and (words := " ".join("".join(text).split())):
                out.append((own, words, min(linked, len(words))))
            text.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece and not stack[-1].dropped:
            text.append(unescape(piece))
            linked += len(piece.strip()) if links else 0
        elif piece and not stack[-1].hard and (n := len(" ".join(unescape(piece).split()))):
            up: Element | None = stack[-1]
            while up:
                up.lost += n
                up = up.parent

    end = len(html)
    while at < end:
        m = TAG.search(html, at)
        if not m:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):  # an end tag closes what is open inside
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                if any(e.tag not in INLINE for e in stack[depth:]):
                    flush()
                links -= sum(e.tag == "a" for e in stack[depth:])
                del stack[depth:]
            continue
        if tag == "br":
            say(" ")
        if tag not in INLINE:
            flush()
        if tag in RAW:
            if not m.group(0).endswith("/>"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else end
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:  # what a new block closes
            depth = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in BOUNDS.get(tag, ()) or tag not in CLOSES and stack[i].tag not in INLINE and stack[i].tag != "p":
                    break
                if stack[i].tag == "p" or stack[i].tag in CLOSES.get(tag, ()):
                    depth = i
            if depth:
                links -= sum(e.tag == "a" for e in stack[depth:])
                del stack[depth:]
        parent = stack[-1]
        count += 1
        hard, names = (True, frozenset()) if parent.hard else _left_out(tag, m.group(3), parent)
        stack.append(own := Element(tag, parent, count, hard, names, count in lifted))
        if not own.hard and names and count not in lifted:
            named.append(own)
        if not own.hard and tag in ARTICLES:
            articles.append(own)
        links += tag == "a"
    flush()
    return out, named, articles


def main_text(html: str | None) -> str:
    """The main text of a page."""
    html = html or ""
    found, named, articles = blocks(html)
    text = _best(found)
    if not any(e.lost for e in named):
        return text
    total = sum(len(words) for _, words, _ in found) + named[0].line()[-1].lost
    lifted: frozenset[int] = frozenset()
    if articles and all(e.dropped for e in articles):
        holders = max(articles, key=lambda e: e.lost).line()
        if holders[0].lost > len(text) and not any(e.names & COMMENTS for e in holders):
            lifted = frozenset(e.number for e in holders if e.names)
            text = _best(blocks(html, lifted)[0])
    plain = [e for e in named if not e.names & COMMENTS]
    for more in ([e for e in plain if 2 * e.lost >= total], plain, named):
        if text and (len(text) >= LEAST_LEFT * total or more is named):
            break
        if not lifted.issuperset(e.number for e in more):
            lifted |= {e.number for e in more}
            text = _best(blocks(html, lifted)[0])
    return text


def _best(found: list[tuple[Element, str, int]]) -> str:
    """The blocks of the best container and of what belongs to it."""
    heard: dict[int, Element] = {}
    for own, words, linked in found:
        density = linked / len(words)
        points = (1 + words.count(",") + min(len(words) / 100, 3)) * (1 - density)
        up, level = own.parent if own.tag in PARAGRAPHS and own.parent else own, 0
        while up:
            up.score += points / (1 if not level else 2 if level == 1 else 3 * level)
            heard[id(up)] = up
            up, level = up.parent, level + 1
        e: Element | None = own
        while e:
            e.chars += len(words)
            e.linked += linked
            e = e.parent
    if not heard:
        return ""
    rated = {k: e.score * (1 - e.linked / e.chars) for k, e in heard.items() if e.tag not in PARAGRAPHS or e.tag in ("td", "blockquote")} or {
        k: e.score for k, e in heard.items()}
    best = heard[max(rated, key=rated.get)]
    within = None  # the page's <main>, if the best container is in it
    e = best
    while e:
        if e.tag == "article":
            best = e
        if e.tag == "main":
            within = e
        e = e.parent
    whole = best.tag == "article"
    least = max(10, 0.2 * best.score)
    headed = {id(e) for own, _, _ in found if own.tag == "h1" for e in own.line()}

    def beside(e: Element, words: str, level: int, before: bool) -> bool:
        """Whether what stands beside the best container, or beside one around it, belongs to the text."""
        if e.linked > 0.25 * e.chars:
            return False
        if e.tag == "h1" or id(e) in headed and e.chars <= 300:
            return True
        if level and within is None:
            return False
        if before and not whole and words.endswith((".", "!", "?")):  # an introduction
            return True
        if whole:  # other articles, and headings of this one
            return level == 0 and (e.tag in HEADINGS or e.score >= least or e.tag == "p" and (e.chars > 80 or words.endswith(".")))
        return within is not None or e.tag in HEADINGS or e.tag in LISTS or e.score >= least or e.tag == "p" and (e.chars > 80 or words.endswith("."))

    around = {id(e): i for i, e in enumerate(best.line()[1:] if within is None else best.line()[1:best.line().index(within) + 1] if within is not best else [])}
    kept, before = [], True
    for own, words, _ in found:
        line = own.line()
        at = next((i for i, e in enumerate(line) if e is best), None)
        if at is not None:
            before = False
            # in no article, a part of the best container that is mostly links is a menu
            menus = () if whole or within is None else (e for e in line[:at] if e.tag not in PARAGRAPHS and e.tag not in INLINE and 2 * e.linked > e.chars)
            if not any(True for _ in menus):
                kept.append(words)
            continue
        i, up = next(((i, e) for i, e in enumerate(line) if id(e) in around), (0, None))
        if up is not None and i and beside(line[i - 1], words, around[id(up)], before):
            kept.append(words)
    return "\n".join(kept)


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, text (the main text of the whole page) and n_chars (its code points)."""
    rows = df.select(df[key].alias(key), df[url].alias(url), df[html].cast("string").alias("html_"))

    def run(batches):
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[key, url, "text", "n_chars"])

    return ship(rows).mapInArrow(run, T.StructType([df.schema[key], df.schema[url], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
