"""Main text of web pages from streaming parser events and smoothed text-to-tag ratios.

One pass of the standard library's event parser turns a page into *lines*, one per block
element, each with its text, its number of tags, its text inside links and its place in
the tree of containers. Text that cannot be content (scripts, styles, navigation,
headers and footers of the page, asides, forms, elements that are not displayed, and
elements whose role or names as a whole say advert, notice, sidebar, menu, comments and the
like) never enters a line. Names of states (``no-sidebar``, ``comments-open``) say nothing. An
element with such a word only as part of a name (``related-work``, ``share-price``) stays if
its own text lies in the content regions. Names are wrong, and their elements stay, where
elements of one name hold most text of the regions; so are all names that together exclude
three quarters of it. Names of reader comments and sidebars are wrong only if the page has
nothing else: no text of an ``article`` or ``main`` element and no paragraph in the regions
outside them. So a thread of comments is left out however much longer than its article it is.

The ratio of text outside links to tags is computed per line, smoothed along the page with a
Gaussian, and lines above a threshold (the ratios' standard deviation, CETR's choice, or
the border of two clusters if that is lower) form the content regions. All ``article``
elements with such lines, or else ``main``, are the article if they hold more text of the
regions than what stands before them; otherwise it is the smallest container that holds the
regions whole. All its lines are returned, so short paragraphs between long ones stay, but
for ``article`` elements inside an article that follow text of its own: those are comments on it.

Defined results: a null or empty page, and one without content, has the empty text; unclosed
and stray tags are tolerated (a block element ends at the next closing tag of a container
around it); a line break element is white space; repeated rows give repeated rows. Whole pages are
parsed, whatever their length and depth: time and memory grow with the page, not with the nesting.
:func:`extract` keeps all columns.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea iframe object svg canvas dialog menu audio video".split()
)
CONTAINER = frozenset("html body main article section div table tbody tr td th center".split())
BLOCK = CONTAINER | frozenset(
    "address blockquote caption dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr legend li ol p pre summary thead tfoot ul".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay sidebar aside rail menu menus nav navbar navigation breadcrumb breadcrumbs topbar masthead header footer comment comments disqus "
    "replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar "
    "pagination pager skip".split()
)
#: Words for readers and for what they write: together they name reader comments.
READERS = frozenset("community guest guests member members reader readers user users visitor visitors".split())
TALK = frozenset("discussion discussions feedback letters opinions reaction reactions response responses".split())
#: Hints that are wrong only on a page without anything else.
REMARKS = frozenset("comment comments disqus replies reply respond".split())
#: Words beside ``sidebar`` that tell of a frame around the article too.
FRAME = frozenset("body container content layout main outer page with wrap wrapper".split())
#: Words beside hints in names that still say nothing of a text of the page's own.
FILLER = frozenset(
    "area article articles bar block body bottom box button buttons card center col column container content div entry footer global group holder icon icons "
    "inner item items layer left link links list main message outer page panel place placeholder post posts primary region right row secondary section site "
    "slot small text thread title top unit wrap wrapper zone".split()
)
#: Names of states: ``no-sidebar``, ``comments-open``.
STATE = re.compile(r"(?:no|not|has|have|with|without|hide|show|is)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|on|off|allowed|count|visible|hidden)")
#: Words that mark an article element as none of the page's own.
MARKS = frozenset("comment comments reply replies teaser teasers related recommended promo sponsored ad advert".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAME = re.compile(r"[a-z0-9]+")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Code points of a line outside links that make it a paragraph.
PARAGRAPH = 40


class Line:
    """Text of one block element and what stands around it."""

    __slots__ = ("events", "linked", "node", "tags", "text")

    def __init__(self, node: int):
        self.events: list[tuple[int, str, int, int]] = []  # innermost hinted element around, text, tags, linked
        self.tags, self.linked, self.node, self.text = 0, 0, node, ""

    def without(self, dropped: list[bool]) -> Line:
        """The line as it is without the events of elements that are ``dropped`` (last: no element)."""
        new = Line(self.node)
        new.events = [e for e in self.events if not dropped[e[0]]]
        new.text = " ".join("".join(e[1] for e in new.events).split())
        new.tags, new.linked = sum(e[2] for e in new.events), sum(e[3] for e in new.events)
        return new


class Tree:
    """Containers in the order of their start tags; -1 stands for the page."""

    def __init__(self) -> None:
        self.kinds: list[str] = []
        self.parent: list[int] = []
        self.end: list[int] = []  # the number after the last container inside
        self.outer: list[dict[str, int]] = []  # the outermost article and main around, if any

    def open(self, kind: str, parent: int) -> int:
        number = len(self.kinds)
        outer = self.outer[parent] if parent >= 0 else {}
        if kind in ("article", "main") and kind not in outer:
            outer = {**outer, kind: number}
        self.kinds.append(kind)
        self.parent.append(parent)
        self.end.append(-1)
        self.outer.append(outer)
        return number

    def around(self, nodes: list[int], kind: str | None = None) -> int:
        """The deepest container (of a kind) that holds all of ``nodes``; -1 is none."""
        first, last = min(nodes), max(nodes)
        while first >= 0 and (self.end[first] <= last or kind not in (None, self.kinds[first])):
            first = self.parent[first]
        return first


class PageLines(HTMLParser):
    """Collects the lines of a page from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.tree = Tree()
        self.stack: list[tuple[str, bool, int]] = []  # open elements: name, skipped, container or -1
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # of open elements in the stack, by name
        self.containers: list[tuple[int, int]] = []  # open ones: place in the stack, number
        self.degree: list[int] = []  # of hinted elements, by number: see _hint
        self.names: list[str] = []  # their tags and names
        self.above: list[int] = []  # the hinted element around each, or -1
        self.outermost: list[bool] = []  # none of its name is around it
        self.hinted: list[tuple[int, int]] = []  # open ones: place in the stack, number
        self.open_names: Counter[str] = Counter()
        self.skipped = self.links = 0
        self.article = False
        self.line: Line | None = None

    def parse_marked_section(self, i: int, report: int = 1) -> int:  # odd declarations are comments
        return self.parse_bogus_comment(i)

    def close(self) -> None:
        super().close()
        while self.stack:
            self._pop()

    # events

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self._tag(tag)
            if tag == "br":
                self._text(" ")
            elif tag == "hr":
                self.line = None
            return
        named = dict(attrs)
        if tag in ("article", "main"):
            if (self.skipped or self.hinted and not self.article) and self._hint(tag, named) < 2:
                self._leave_hinted()
            self.article = True
        if tag == "p" and self.places["p"] and self.places["p"][-1] >= len(self.stack) - 8:
            self._close("p")
        skip = self._is_skipped(tag, named)
        hint = 0 if skip else self._hint(tag, named)
        number = -1
        if tag in BLOCK:
            self.line = None
            if tag in CONTAINER:
                number = self.tree.open(tag, self._inner())
                self.containers.append((len(self.stack), number))
        if hint:
            name = f"{tag} {named.get('class') or named.get('id')}"
            self.above.append(self._around())
            self.outermost.append(not self.open_names[name])
            self.open_names[name] += 1
            self.hinted.append((len(self.stack), len(self.names)))
            self.degree.append(hint)
            self.names.append(name)
        self.places[tag].append(len(self.stack))
        self.stack.append((tag, skip, number))
        self.skipped += skip
        self.links += tag == "a"
        self._tag(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._tag(tag)
        if tag == "br":
            self._text(" ")
        self._close(tag)

    def handle_data(self, data: str) -> None:
        self._text(data)

    # state

    def _inner(self) -> int:
        return self.containers[-1][1] if self.containers else -1

    def _around(self) -> int:
        return self.hinted[-1][1] if self.hinted else -1

    def _inside(self) -> bool:
        return bool(self.places["article"] or self.places["main"])

    def _is_skipped(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in SKIPPED or (tag == "header" and not self._inside()):
            return True
        if tag in ("html", "body"):
            return False
        if "hidden" in attrs or _UNSEEN.search(attrs.get("style") or ""):
            return True
        return (attrs.get("role") or "").lower() in ROLES

    def _hint(self, tag: str, attrs: dict[str, str | None]) -> int:
        """3 if a class name or the id as a whole says comments or sidebar, 2 if it is another
        hint as a whole, 1 if in part, else 0."""
        if tag in ("html", "body", "main", "a", "b", "i", "em", "strong"):
            return 0
        found = 0
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()
        frame = any(not FRAME.isdisjoint(_NAME.findall(name)) for name in names)
        for name in names:
            words = set(_NAME.findall(name))
            own = words & HINTS if tag != "article" else words & MARKS
            if "header" in own and self._inside():
                own = own - {"header"}
            talk = bool(words & READERS) and bool(words & (TALK | REMARKS))
            if (own or talk) and not STATE.fullmatch(name):
                rest = words - HINTS - MARKS - FILLER - (READERS | TALK if talk else frozenset())
                whole = all(w.isdigit() for w in rest)
                firm = whole and (talk or bool(words & REMARKS) or "sidebar" in words and not frame)
                found = max(found, 3 if firm else 2 if whole else 1)
        return found if tag != "article" or found >= 2 else 0

    def _pop(self) -> str:
        tag, skip, number = self.stack.pop()
        self.places[tag].pop()
        self.skipped -= skip
        self.links -= tag == "a"
        if number >= 0:
            self.containers.pop()
            self.tree.end[number] = len(self.tree.kinds)
        if self.hinted and self.hinted[-1][0] >= len(self.stack):
            self.open_names[self.names[self.hinted.pop()[1]]] -= 1
        return tag

    def _close(self, tag: str) -> None:
        if not self.places[tag]:
            return
        place = self.places[tag][-1]
        if tag not in CONTAINER and tag not in SKIPPED and tag != "header" and self.containers and self.containers[-1][0] > place:
            return  # a stray end tag does not reach beyond its container
        while len(self.stack) > place:
            if self._pop() in BLOCK:
                self.line = None

    def _leave_hinted(self) -> None:
        """An article opens inside something skipped only by its names, left unclosed."""
        while self.stack and (self.skipped or self.hinted) and self.stack[-1][0] not in SKIPPED:
            self._pop()

    def _tag(self, tag: str) -> None:
        if self.line is not None and not self.skipped:
            self.line.events.append((self._around(), "", 1, 0))

    def _text(self, data: str) -> None:
        if self.skipped:
            return
        if self.line is None:
            if not data.strip():
                return
            self.line = Line(self._inner())
            self.lines.append(self.line)
        self.line.events.append((self._around(), data, 0, len(data.strip()) if self.links else 0))


def page_lines(html: str, sigma: float = SIGMA) -> tuple[list[Line], Tree]:
    """Lines with text that can be content, white space reduced, and the tree of the
    page's containers."""
    parser = PageLines()
    parser.feed(html)
    parser.close()
    dropped = misnamed(parser, sigma) if parser.names else [False]
    return [y for x in parser.lines if (y := x.without(dropped)).text], parser.tree


def _spread(dropped: list[bool], above: list[int]) -> list[bool]:
    """Elements that are dropped or stand inside such; one more entry, for no element."""
    out: list[bool] = []
    for own, k in zip(dropped, above):
        out.append(own or k >= 0 and out[k])
    return [*out, False]


def misnamed(parser: PageLines, sigma: float) -> list[bool]:
    """Whether each hinted element is left out (last: False, no element), by the smoothed ratios of the whole page."""
    n, above = len(parser.names), parser.above
    none = [False] * (n + 1)
    full = [(x, y) for x in parser.lines if (y := x.without(none)).text]
    chosen = content_mask(smoothed_ratios([y for _, y in full], sigma)) if full else []
    firm = _spread([d == 3 for d in parser.degree], above)
    # characters of each element, by the innermost around: all, and those outside links in regions
    total, inside = [0] * (n + 1), [0] * (n + 1)
    others = False  # text of the page's own outside comments and sidebars
    for (x, y), on in zip(full, chosen):
        on = on and 2 * y.linked < len(y.text)
        own = 0
        for k, text, _, linked in x.events:
            size = len(text.strip())
            total[k] += size
            inside[k] += on * (size - linked)
            own += 0 if firm[k] else size - linked
        others |= own > 0 and (on and own >= PARAGRAPH or x.node >= 0 and bool(parser.tree.outer[x.node]))
    region = sum(inside)
    at = inside[:]  # by the innermost element
    for k in range(n - 1, -1, -1):
        if above[k] >= 0:
            total[above[k]] += total[k]
            inside[above[k]] += inside[k]
    dropped = [parser.degree[k] > 1 or 2 * inside[k] <= total[k] for k in range(n)]
    held = [others and parser.degree[k] == 3 for k in range(n)]
    alike = Counter()
    for k in range(n):
        if parser.outermost[k]:
            alike[parser.names[k]] += inside[k]
    dropped = [d and (h or 2 * alike[name] <= region) for d, h, name in zip(dropped, held, parser.names)]
    out = _spread(dropped, above)
    if 4 * sum(size for size, off in zip(at, out) if off) > 3 * region:
        out = _spread(held, above)
    return out if any(not out[k] for x in parser.lines for k, text, _, _ in x.events if text.strip()) else none


def smoothed_ratios(lines: list[Line], sigma: float = SIGMA) -> np.ndarray:
    """Text outside links per tag of each line, smoothed along the page."""
    ratio = np.array([max(0, len(x.text) - x.linked) / (1 + x.tags) for x in lines], float)
    reach = int(np.ceil(3 * sigma))
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratio, weight)[reach : reach + len(ratio)]
    return total / np.convolve(np.ones(len(ratio)), weight)[reach : reach + len(ratio)]


def content_mask(ratios: np.ndarray) -> np.ndarray:
    """Lines above the threshold: the standard deviation, or the middle between the means of
    two clusters if that is lower."""
    low, high = ratios.min(), ratios.max()
    for _ in range(20):
        near_high = ratios > (low + high) / 2
        if not near_high.any() or near_high.all():
            break
        new = ratios[~near_high].mean(), ratios[near_high].mean()
        if new == (low, high):
            break
        low, high = new
    return ratios >= min(ratios.std(), (low + high) / 2)


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article's blocks, joined by two line breaks."""
    lines, tree = page_lines(html or "", sigma)
    if not lines:
        return ""
    chosen = content_mask(smoothed_ratios(lines, sigma))
    # lines of links that smoothing lifted beside a text do not widen the article
    region = [x for x, on in zip(lines, chosen) if on and 2 * x.linked < len(x.text)]
    return "\n\n".join(x.text for x in _article(lines, region, tree))


def _article(lines: list[Line], region: list[Line], tree: Tree) -> list[Line]:
    """The lines of the article, by the lines of the content regions."""
    for kind in ("article", "main"):
        nodes: defaultdict[int, list[int]] = defaultdict(list)
        before = own = 0
        for x in region:
            if x.node >= 0 and kind in tree.outer[x.node]:
                nodes[tree.outer[x.node][kind]].append(x.node)
                own += len(x.text)
            elif not nodes:
                before += len(x.text)
        if own > before:
            return _inside(lines, region, tree, {tree.around(found, kind) for found in nodes.values()}, kind)
    common = tree.around([x.node for x in region]) if region and min(x.node for x in region) >= 0 else -1
    return _inside(lines, region, tree, {common}) if common >= 0 else lines


def _inside(lines: list[Line], region: list[Line], tree: Tree, chosen: set[int], kind: str | None = None) -> list[Line]:
    """The lines in ``chosen`` containers. Articles in an article that follow text of its own are not of it."""
    article: list[int] = []  # of each container: the innermost article from a chosen one on, else -1
    holder: list[int] = []  # of each container: the chosen one around it, else -1
    for k, (tag, up) in enumerate(zip(tree.kinds, tree.parent)):
        holder.append(k if k in chosen else holder[up] if up >= 0 else -1)
        nested = holder[k] >= 0 and (k in chosen or tag == "article")
        article.append(k if nested else article[up] if up >= 0 else -1)
    content = {id(x) for x in region}
    begun: set[int] = set()  # chosen articles whose own text has begun
    out = []
    for x in lines:
        if x.node < 0 or holder[x.node] < 0:
            continue
        own = article[x.node] == holder[x.node]
        if own and id(x) in content:
            begun.add(holder[x.node])
        if own or kind != "article" or holder[x.node] not in begun:
            out.append(x)
    return out


def _extract(batches: Iterator[pa.RecordBatch], html: str, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), 500):
            part = batch.slice(lo, 500)
            texts = [main_text(x) for x in part.column(html).to_pylist()]
            columns = [*part.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *names])


def extract(pages: DataFrame, html: str = "html", names: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """``pages`` with the main text and its number of code points as two more columns."""
    if taken := set(names) & set(pages.columns):
        raise ValueError(f"pages have columns {sorted(taken)} already; choose other names")
    schema = pages.select(*pages.columns, F.lit("").alias(names[0]), F.lit(0).cast("long").alias(names[1])).schema
    return pages.mapInArrow(partial(_extract, html=html, names=names), schema)
