"""Main text of web pages by wrappers inferred from all pages of a host.

A wrapper is a union-free regular expression over tags and texts. It starts as
one page's stream (nested by its tags) and is aligned with the next: adjacent
groups of one to three elements that recur become repeated groups, elements
without a partner become optional, texts that differ become slots. The wrapper
gives the path to the region to read: the deepest article or main that holds most
of the slots' text, else the lowest element that holds all of it; and the texts
inside it that stand at their place on all pages (of at least ``AGREE`` that
differ), if they are few: pages that are near copies have no template texts.

Pages of a host are wrapped by layout: the nesting of their divisions, digits in
class names aside. Each task merges the pages it reads into one wrapper a host and
layout; these partial wrappers are merged in two steps by host and layout, so that a
host of any size is spread over all tasks, and every page counts. A wrapper stays
about as large as a page: a list of more than ``WIDTH`` elements becomes one of
optional, repeated elements, one a signature.

Each page is then read in one pass: blocks of text inside its wrapper's region,
without the wrapper's constant texts where they stand in it, and without menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.
These are known by tag, role or being hidden; or by class or id, but then only
beside the page's article, never around it (:func:`kept_marks`): a class may as well
tell of what a page has or belongs to.

A page in which the region does not occur is read by its own wrapper. The join of
pages with wrappers has a plain exchange on either side, so that Spark can split
the partition of a large host.

Defined results: a null or empty html gives an empty text; a null url is the
host "" (its pages share wrappers); repeated rows each have their row and count as
one page for ``AGREE``; broken markup is read as far as it goes; pages of any length
and depth are read alike, in time linear in them but for the alignment of long
irregular lists (a bit an element and element); an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import html as entities
import pickle
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_frames, written

#: Differing pages that must agree on a text for it to be part of the template.
AGREE = 5
#: Share of a page's text in the region that template texts may have.
TEMPLATE = 0.2
#: Elements of a list that keep their order in a wrapper of several pages.
WIDTH = 48
#: Share of a page's text that must stand beside marked elements for the marks to be believed.
BESIDE = 0.1
#: Elements of partial wrappers that a task holds at a time, and steps by which they are merged.
HELD, SPREAD = 400_000, 64

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr img".split())
_REGIONS = frozenset("html body div section main article td tr table tbody center".split())
_DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg canvas object button select "
                     "option textarea input dialog menu audio video map".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
_MARKS = frozenset("nav navbar navigation menu footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor "
                   "sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
                   "subscription share sharing social comment comments commentlist reply replies respond disqus related "
                   "recommended breadcrumb breadcrumbs pagination pager widget toolbar login signup hidden".split())
_SITE_MARKS = frozenset("header masthead banner topbar".split())
#: First or last parts of class names that tell what an element has, or belongs to, not what it is.
_STATES = frozenset("has no not with without is tag category cat topic section type format".split())
_STATE_ENDS = frozenset("open opened closed on off enabled disabled allowed visible active none".split())
#: An element that closes an open one of the same set.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_DIVISIONS = frozenset("div section main article".split())
#: Levels that paths tell apart; what is below counts as being there.
_DEEP = 200
#: What may stand in a head; anything else closes it.
_HEAD = frozenset("base basefont bgsound link meta title noscript script style template noframes".split())
_PARAGRAPH = frozenset("p")
_SCOPES = frozenset("ul ol dl table select article section div body html main nav footer aside header".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
      | <[!?][^>]*>
      | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+)>
      | <(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>""",
    re.S | re.I | re.X)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[\s_\-:]+")
_NUMBER = re.compile(r"\d+")


def _stream(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, attributes) and ("close", name, "")."""
    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            yield "text", html[at:m.start()], ""
        at = m.end()
        _, end, name, rest, end2, name2, rest2 = m.groups()
        if name or name2:
            if end or end2:
                yield "close", (name or name2).lower(), ""
            else:
                yield "open", (name or name2).lower(), rest or rest2 or ""
    if at < len(html):
        yield "text", html[at:], ""


def _marks(classes: str, id_: str) -> set[str]:
    """The parts of class names and id, without those of names that tell a state."""
    out = set()
    for token in f"{classes} {id_}".lower().split():
        parts = [p for p in _PARTS.split(token) if p]
        if len(parts) < 2 or parts[0] not in _STATES and parts[-1] not in _STATE_ENDS:
            out.update(parts)
    return out


def _described(name: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
    """Signature of an element (tag and classes), whether it is left out, and
    whether its class or id says that it should be."""
    if not attributes or name in ("html", "body"):
        return name, name in _DROPPED or (name == "header" and not in_article), False
    return (_by_attributes if len(attributes) <= 256 else _by_attributes.__wrapped__)(name, attributes, in_article)


@functools.lru_cache(maxsize=1 << 14)
def _by_attributes(name: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    classes = found.get("class", "")
    marks = _marks(classes, found.get("id", ""))
    drop = (name in _DROPPED or name == "header" and not in_article or found.get("role", "").lower() in _ROLES
            or "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower())
    marked = bool(marks & _MARKS) or not in_article and bool(marks & _SITE_MARKS)
    listed = ".".join(sorted({_NUMBER.sub("0", c) for c in classes.lower().split()}))
    return f"{name}.{listed}" if listed else name, drop, marked


class Reader:
    """Walks a page's stream: keeps the open elements as browsers do. Elements
    are numbered as they open; marks of those in ``kept`` are not believed."""

    def __init__(self, kept: frozenset[int] = frozenset()):
        self.names: list[str] = []
        self.path: list[str] = []
        self.drops: list[bool] = []
        self.opened: defaultdict[str, int] = defaultdict(int)
        self.kept = kept
        self.number = 0
        self.own = (False, False)  # of the element opened last: left out, marked

    def text(self, value: str) -> None:
        if self.names and self.names[-1] == "head" and value.strip():
            self._cut(len(self.names) - 1)

    def void(self, name: str) -> None:
        if self.names and self.names[-1] == "head" and name not in _HEAD:
            self._cut(len(self.names) - 1)

    def open(self, name: str, attributes: str) -> None:
        self.void(name)
        if name == "body":
            self.close("head")
        closes = _CLOSES.get(name)
        if any([self.opened[c] for c in closes]) if closes else name not in _INLINE and self.opened["p"]:
            closes = closes or _PARAGRAPH
            for k in range(len(self.names) - 1, -1, -1):
                if self.names[k] in closes:
                    self._cut(k)
                    break
                if self.names[k] in _SCOPES:
                    break
        inside = bool(self.opened["article"] or self.opened["main"])
        signature, drop, marked = _described(name, attributes, inside)
        self.own = drop, marked
        self.names.append(name)
        self.opened[name] += 1
        self.path.append(signature)
        self.drops.append(drop or marked and self.number not in self.kept or bool(self.drops and self.drops[-1]))
        self.number += 1

    def close(self, name: str) -> None:
        if self.opened[name]:
            for k in range(len(self.names) - 1, -1, -1):
                if self.names[k] == name:
                    self._cut(k)
                    return

    def _cut(self, k: int) -> None:
        for name in self.names[k:]:
            self.opened[name] -= 1
        del self.names[k:], self.path[k:], self.drops[k:]

    @property
    def dropped(self) -> bool:
        return bool(self.drops) and self.drops[-1]


@dataclass(eq=False, slots=True)
class Element:
    """An element of a wrapper; a text has the signature ""."""

    signature: str
    dropped: bool = False
    optional: bool = False
    repeated: bool = False
    text: str | None = None  # None: a slot
    common: frozenset[str] = frozenset()  # texts that every page has here
    volume: int = 0
    children: list[Element] = field(default_factory=list)
    marked: bool = False  # by class or id alone
    number: int = -1

    def __str__(self) -> str:
        out: list[str] = []
        todo: list[Element | str] = [self]
        while todo:
            one = todo.pop()
            if isinstance(one, str):
                out.append(one)
                continue
            group = one.optional or one.repeated
            after = ")" + ("*" if one.optional and one.repeated else "+" if one.repeated else "?") if group else ""
            out.append("(" if group else "")
            if not one.signature:
                out += ["#" if one.text is None else one.text, after]
                continue
            if one.signature != "()":
                out.append(f"<{one.signature}>")
                after = f"</{one.signature.split('.')[0]}>" + after
            todo += [after, *reversed(one.children)]
        return "".join(out)


#: A numeric reference of many digits: eight without leading zeros are beyond all code points.
_LONG_NUMBER = re.compile(r"&#(?=[0-9]{9})0*([0-9]{1,8})[0-9]*")


def _clean(text: str) -> str:
    if "&" in text:
        text = entities.unescape(_LONG_NUMBER.sub(r"&#\1", text))
    return " ".join(text.split())


def _walk(root: Element) -> list[Element]:
    """An element and all below it, each before what it holds."""
    out, todo = [], [root]
    while todo:
        one = todo.pop()
        out.append(one)
        todo += reversed(one.children)
    return out


def _sums(order: list[Element], value) -> dict[int, int]:
    """For each element (by identity) of :func:`_walk` the sum of ``value`` over
    the texts in it, nothing below dropped ones."""
    out: dict[int, int] = {}
    for one in reversed(order):
        total = 0
        if not one.dropped:
            if one.signature:
                for c in one.children:
                    total += out[id(c)]
            else:
                total = value(one)
        out[id(one)] = total
    return out


def raw_tree(html: str) -> Element:
    """A page as nested elements; ``dropped`` is what tag, role or being hidden
    say, marks by class are not yet believed."""
    root, reader = Element("page"), Reader()
    open_elements = [root]
    for kind, value, attributes in _stream(html):
        if kind == "text":
            reader.text(value)
            del open_elements[len(reader.path) + 1:]
            if text := _clean(value):
                holder = open_elements[-1]
                holder.children.append(Element("", holder.dropped, text=text, common=frozenset((text,)), volume=len(text)))
        elif kind == "open" and value in _VOID:
            reader.void(value)
            del open_elements[len(reader.path) + 1:]
        elif kind == "open":
            number = reader.number
            reader.open(value, attributes)
            del open_elements[len(reader.path):]
            drop, marked = reader.own
            element = Element(reader.path[-1], drop or open_elements[-1].dropped, marked=marked, number=number)
            open_elements[-1].children.append(element)
            open_elements.append(element)
        else:
            reader.close(value)
            del open_elements[len(reader.path) + 1:]
    return root


def kept_marks(root: Element) -> frozenset[int]:
    """The marked elements of a page that are read all the same, by number: those
    around its article. That is the article or main with most text, one in no list
    of marked ones (as readers' comments may be) before others, if it has more text
    than stands beside marked elements. Else, as long as less than ``BESIDE`` of the
    text stands beside them, the outermost of these with most text is read."""
    order = _walk(root)
    text = _sums(order, lambda e: e.volume)
    beside, outer = _outermost(root)
    if not outer or not text[id(root)]:
        return frozenset()
    parent = {id(c): e for e in order for c in e.children}
    articles = [e for e in order if e.signature.split(".")[0] in ("article", "main") and not e.dropped and text[id(e)]]
    if articles:
        inside = {id(e): 0 for e in order}  # articles in each element
        for e in reversed(order):
            for c in e.children:
                inside[id(e)] += inside[id(c)] + (c.signature.split(".")[0] == "article")
        listed: dict[int, bool] = {}
        for e in order:  # in a marked element with several articles, or marked itself
            up = parent.get(id(e))
            above = up is not None and (listed[id(up)] or up.marked and inside[id(up)] > 1)
            listed[id(e)] = above
        best = max(articles, key=lambda e: (not (listed[id(e)] or e.marked), text[id(e)]))
        if text[id(best)] > beside:
            kept = []
            while best is not root:
                if best.marked:
                    kept.append(best.number)
                best = parent[id(best)]
            return frozenset(kept)
    kept = []
    heap = [(-text[id(e)], e.number, e) for e in outer]
    heapq.heapify(heap)
    while heap and beside < BESIDE * text[id(root)]:
        volume, number, e = heapq.heappop(heap)
        if not volume:
            break
        kept.append(number)
        more, inner = _outermost(e)
        beside += more
        for x in inner:
            heapq.heappush(heap, (-text[id(x)], x.number, x))
    return frozenset(kept)


def _outermost(element: Element) -> tuple[int, list[Element]]:
    """The text in an element beside marked ones, and these (not those in them)."""
    beside, outer, todo = 0, [], list(element.children)
    while todo:
        one = todo.pop()
        if one.dropped:
            continue
        if one.marked:
            outer.append(one)
        elif one.signature:
            todo += one.children
        else:
            beside += one.volume
    return beside, outer


def page_tree(html: str) -> Element:
    """A page as a wrapper of its own."""
    root = raw_tree(html)
    return _folded(_settled(root, kept_marks(root)))


def _settled(root: Element, kept: frozenset[int]) -> Element:
    """Marked elements that are not kept are dropped, with all they hold."""
    for one in _walk(root):
        if one.marked and one.number not in kept:
            one.dropped = True
        if one.dropped:
            for c in one.children:
                c.dropped = True
    return root


def layout(root: Element) -> int:
    """A number for the nesting of a settled page's divisions that hold text,
    down to its article."""
    order = _walk(root)
    text = _sums(order, lambda e: e.volume)
    found, todo = {0}, [(root, 0)]
    while todo:
        one, path = todo.pop()
        for c in one.children:
            name = c.signature.split(".")[0]
            if not c.signature or c.dropped or not text[id(c)]:
                continue
            inner = zlib.crc32(c.signature.encode("utf-8", "replace"), path) if name in _DIVISIONS else path
            if name in _DIVISIONS:
                found.add(inner)
            if name not in ("article", "main"):
                todo.append((c, inner))
            elif name == "main":
                todo += [(a, inner) for a in _walk(c)[1:] if a.signature.split(".")[0] == "article" and not a.dropped][:1]
    return zlib.crc32(repr(sorted(found)).encode())


def _folded(root: Element) -> Element:
    """Adjacent groups that recur become one repeated group, everywhere below."""
    for element in reversed(_walk(root)):
        element.children = _groups(element.children)
    return root


def _groups(children: list[Element]) -> list[Element]:
    out: list[Element] = []
    at = 0
    while at < len(children):
        for size in (1, 2, 3):
            group = [c.signature for c in children[at:at + size]]
            times = 1
            while len(group) == size and all(group) and \
                    [c.signature for c in children[at + times * size:at + (times + 1) * size]] == group:
                times += 1
            if times > 1:
                merged = [_all_merged(children[at + k:at + times * size:size]) for k in range(size)]
                one = merged[0] if size == 1 else Element("()", all([m.dropped for m in merged]), children=merged)
                one.repeated = True
                out.append(one)
                at += times * size
                break
        else:
            out.append(children[at])
            at += 1
    return out


def _all_merged(elements: list[Element]) -> Element:
    """The elements of a repeated group as one, two by two, so that long runs
    cost no more than their length at each level."""
    while len(elements) > 1:
        elements = [_merged(elements[i], elements[i + 1], frozenset.union) if i + 1 < len(elements) else elements[i]
                    for i in range(0, len(elements), 2)]
    return elements[0]


def _merged(a: Element, b: Element, common=frozenset.intersection) -> Element:
    """One element for two; ``common`` joins the texts of one page's (union) or
    of two pages' elements (intersection)."""

    def joined(a: Element, b: Element) -> Element:
        out = Element(a.signature, a.dropped and b.dropped, a.optional or b.optional, a.repeated or b.repeated,
                      a.text if a.text == b.text else None, common(a.common, b.common), a.volume + b.volume)
        todo.append((out, a.children, b.children))
        return out

    todo: list[tuple[Element, list[Element], list[Element]]] = []
    wide: list[Element] = []
    root = joined(a, b)
    while todo:
        out, ca, cb = todo.pop()
        if not ca or not cb:
            out.children = [_without_partner(e, common) for e in ca or cb]
            continue
        i = j = 0
        for x, y in [*_partners(ca, cb), (len(ca), len(cb))]:
            out.children += [_without_partner(e, common) for e in ca[i:x]]
            out.children += [_without_partner(e, common) for e in cb[j:y]]
            if x < len(ca):
                out.children.append(joined(ca[x], cb[y]))
            i, j = x + 1, y + 1
        if len(out.children) > WIDTH and common is frozenset.intersection:
            wide.append(out)
    for out in reversed(wide):
        _loosen(out)
    return root


def _key(e: Element):
    return (e.signature, *[c.signature for c in e.children]) if e.signature == "()" else e.signature


def _partners(a: list[Element], b: list[Element]) -> list[tuple[int, int]]:
    """A longest common subsequence by signature, as rising index pairs."""
    ka, kb = [_key(e) for e in a], [_key(e) for e in b]
    low = 0
    while low < min(len(ka), len(kb)) and ka[low] == kb[low]:
        low += 1
    end = 0
    while end < min(len(ka), len(kb)) - low and ka[-1 - end] == kb[-1 - end]:
        end += 1
    middle = _subsequence(ka[low:len(ka) - end], kb[low:len(kb) - end])
    return ([(i, i) for i in range(low)] + [(low + i, low + j) for i, j in middle]
            + [(len(ka) - end + i, len(kb) - end + i) for i in range(end)])


def _rows(a: list, b: list) -> Iterator[int]:
    """After each element of ``a``, a bit an element of ``b``: 0 where the longest
    common subsequence grows. All bits of a row are worked on at once."""
    full, masks = (1 << len(b)) - 1, {}
    for j, k in enumerate(b):
        masks[k] = masks.get(k, 0) | 1 << j
    row = full
    for k in a:
        hit = row & masks.get(k, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


#: Bits of rows that are held to trace a subsequence back; above, the lists are halved.
_TRACED = 1 << 28


def _subsequence(a: list, b: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) > _TRACED and a1 - a0 > 1:
            half = (a0 + a1) // 2  # the place in b at which both halves' subsequences are longest
            up, down = 0, 0
            for up in _rows(a[a0:half], b[b0:b1]):
                pass
            for down in _rows(a[half:a1][::-1], b[b0:b1][::-1]):
                pass
            n, before, best = b1 - b0, 0, -1
            behind = n - down.bit_count()
            down_bits, up_bits = bin(down)[2:].zfill(n), bin(up)[2:].zfill(n)[::-1]
            for j in range(n + 1):
                if before + behind > best:
                    best, cut = before + behind, b0 + j
                if j < n:
                    before += up_bits[j] == "0"
                    behind -= down_bits[j] == "0"
            todo += [(half, a1, cut, b1), (a0, half, b0, cut)]
            continue
        rows = list(_rows(a[a0:a1], b[b0:b1]))
        i, j, found = len(rows), b1 - b0, []
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    found.append((a0 + i, b0 + j))
        out += reversed(found)
    return out


def _loosen(element: Element) -> None:
    """Make the list in an element one of optional, repeated elements, one a
    signature (one a tag, if these are still too many), in the order in which they
    first stand; and so the lists that come together below."""
    todo = [element]
    while todo:
        one = todo.pop()
        flat = [m for c in one.children for m in (c.children if c.signature == "()" else [c])]
        tags = len({c.signature for c in flat}) > 4 * WIDTH
        by_name: dict[str, list[Element]] = {}
        for c in flat:
            by_name.setdefault(c.signature.split(".")[0] if tags else c.signature, []).append(c)
        one.children = []
        for signature, same in by_name.items():
            out = Element(signature, all([c.dropped for c in same]), True, len(same) > 1 or same[0].repeated,
                          same[0].text if len(same) == 1 else None, frozenset().union(*[c.common for c in same]),
                          sum([c.volume for c in same]), [m for c in same for m in c.children])
            one.children.append(out)
            if len(out.children) > WIDTH:
                todo.append(out)


def _without_partner(element: Element, common) -> Element:
    element.optional = True
    if common is frozenset.intersection:
        for one in _walk(element):  # a page does not have these texts
            one.common = frozenset()
    return element


def region(wrapper: Element, pages: int = 1, differing: int | None = None) -> tuple[list[str], list[Element]]:
    """Path of signatures to the region of a wrapper of ``pages`` pages, and the
    elements at that path: the deepest article or main with most of the slots' text,
    else the lowest that holds all of it. Texts of all pages may stand outside it if
    they are few."""
    agreed = (pages if differing is None else differing) >= AGREE
    known = pages if agreed and _few(list(_constants(wrapper)), pages, [wrapper]) else 0
    order = _walk(wrapper)
    slots = _sums(order, lambda e: e.volume - known * sum([len(t) for t in e.common]))
    best, by_path = None, {}
    todo = [(wrapper, ())]
    while todo:
        one, path = todo.pop()
        for c in one.children:
            if c.dropped or not c.signature or not slots[id(c)]:
                continue
            here = path if c.signature == "()" else (*path, c.signature) if len(path) < _DEEP else path
            if c.signature.split(".")[0] in ("article", "main") and here != path:
                by_path.setdefault(here, []).append(c)
            todo.append((c, here))
    for path, elements in by_path.items():
        held = sum([slots[id(e)] for e in elements])
        if 2 * held >= slots[id(wrapper)] and (best is None or (len(path), held) > (len(best), sum([slots[id(e)] for e in by_path[best]]))):
            best = path
    if best is not None:
        return list(best), by_path[best]
    path, at = [], [wrapper]
    while True:
        flat = [g for e in at for c in e.children for g in (c.children if c.signature == "()" else [c])]
        holders = [c for c in flat if slots[id(c)]]
        signatures = {c.signature for c in holders}
        if len(signatures) != 1 or holders[0].signature.split(".")[0] not in _REGIONS:
            return path, at
        path.append(signatures.pop())
        at = [c for c in flat if c.signature == path[-1]]


def _constants(element: Element, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str]]:
    """Texts that each page has, with the path of signatures to their place."""
    todo = [(element, path)]
    while todo:
        one, path = todo.pop()
        if not one.dropped:
            for text in one.common:
                yield path, text
            for c in one.children:
                todo.append((c, path if c.signature in ("", "()") or len(path) >= _DEEP else (*path, c.signature)))


def _few(constants: list[tuple[tuple[str, ...], str]], pages: int, elements: list[Element]) -> bool:
    volume = sum([_sums(_walk(e), lambda x: x.volume)[id(e)] for e in elements])
    return sum([len(text) for _, text in set(constants)]) * pages <= TEMPLATE * volume


def place(path: Sequence[str], text: str) -> str:
    """A template text with the path to it, as one string."""
    return "\n".join([*path, text])


@dataclass
class Wrapper:
    """A wrapper with the number of its pages, and some of the different ones'
    hashes (the ``AGREE`` least)."""

    tree: Element
    pages: int
    seen: frozenset[int]

    @staticmethod
    def of(tree: Element, html: str) -> Wrapper:
        return Wrapper(tree, 1, frozenset((zlib.crc32(html.encode("utf-8", "surrogatepass")),)))

    def merge(self, other: Wrapper) -> None:
        if self.seen == other.seen and len(self.seen) == 1:  # the same page again
            return
        self.tree = _merged(self.tree, other.tree)
        self.pages += other.pages
        self.seen = frozenset(sorted(self.seen | other.seen)[:AGREE])

    def pack(self) -> bytes:
        """Flat, so that depth does not matter."""
        rows, todo = [], [(self.tree, 0)]
        while todo:
            e, depth = todo.pop()
            rows.append((depth, e.signature, e.dropped, e.optional, e.repeated, e.text, sorted(e.common), e.volume))
            todo += [(c, depth + 1) for c in reversed(e.children)]
        return pickle.dumps((rows, self.pages, sorted(self.seen)))

    @staticmethod
    def unpack(packed: bytes) -> Wrapper:
        rows, pages, seen = pickle.loads(packed)
        above: list[Element] = []
        for depth, signature, dropped, optional, repeated, text, common, volume in rows:
            e = Element(signature, dropped, optional, repeated, text, frozenset(common), volume)
            del above[depth:]
            if above:
                above[-1].children.append(e)
            above.append(e)
        return Wrapper(above[0], pages, frozenset(seen))

    def size(self) -> int:
        return len(_walk(self.tree))

    def places(self) -> tuple[list[str], list[str]]:
        """The region's path, and the :func:`place` of each constant text there."""
        path, at = region(self.tree, self.pages, len(self.seen))
        constants = [c for e in at for c in _constants(e, tuple(path))]
        few = len(self.seen) >= AGREE and _few(constants, self.pages, at)
        return path, sorted({place(*c) for c in constants}) if few else []


def infer_places(htmls: list[str]) -> tuple[str, list[str], list[str]]:
    """The wrapper of some pages as an expression, its region's path, and the
    :func:`place` of each of its constant texts there."""
    wrappers = [Wrapper.of(page_tree(h), h) for h in dict.fromkeys(htmls)]
    if not wrappers:
        return "", [], []
    whole = wrappers[0]
    for one in wrappers[1:]:
        whole.merge(one)
    return str(whole.tree), *whole.places()


def infer(htmls: list[str]) -> tuple[str, list[str], list[str]]:
    """:func:`infer_places` with the constant texts alone."""
    wrapper, path, places = infer_places(htmls)
    return wrapper, path, sorted({p.rpartition("\n")[2] for p in places})


def main_text(html: str | None, path: list[str], constants: frozenset[str], kept: frozenset[int] | None = None) -> str:
    """The page's text blocks in the region at ``path``, joined by blanks,
    without the ``constants`` (as :func:`place` gives them) at their place.
    ``kept``: what :func:`kept_marks` gives for the page, if it is known."""
    if not html:
        return ""
    kept = kept_marks(raw_tree(html)) if kept is None else kept
    found = _blocks(html, path, constants, kept)
    if found is None:
        found = _blocks(html, region(page_tree(html))[0], constants, kept) or []
    return " ".join(found)


def _blocks(html: str, path: list[str], constants: frozenset[str], kept: frozenset[int]) -> list[str] | None:
    """Texts of the region's blocks; None if the region does not occur."""
    reader, blocks, parts, places, seen, n = Reader(kept), [], [], [], not path, len(path)

    def end() -> None:
        if parts:
            if block := _clean("".join(parts)):
                told = [p for part, p in zip(parts, places) if _clean(part)] if constants else []
                if len(told) != 1 or place(told[0], block) not in constants:
                    blocks.append(block)
            parts.clear()
            places.clear()

    for kind, value, attributes in _stream(html):
        if kind == "text":
            reader.text(value)
            if not reader.dropped and reader.path[:n] == path:
                parts.append(value)
                places.append(tuple(reader.path[:_DEEP]) if constants else ())
            continue
        if value not in _INLINE:
            end()
        if value in _VOID:
            if kind == "open":
                reader.void(value)
            continue
        if kind == "open":
            reader.open(value, attributes)
            seen = seen or len(reader.path) == n and reader.path == path
        else:
            reader.close(value)
    end()
    return blocks if seen else None


def _host(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def wrappers_of(plain: DataFrame) -> DataFrame:
    """host, layout, path and constants of every host's layouts, from all pages
    (host, html)."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, held, size = TaskContext.get().partitionId() % SPREAD, {}, 0

        def rows():
            return pd.DataFrame([(host, number, part, w.pack()) for (host, number), w in held.items()],
                                columns=["host", "layout", "part", "wrapper"])

        for frame in frames:
            for host, html in zip(frame["host"], frame["html"]):
                root = raw_tree(html)
                _settled(root, kept_marks(root))
                number = layout(root)
                one = Wrapper.of(_folded(root), html)
                if (host, number) in held:
                    held[host, number].merge(one)
                else:
                    held[host, number] = one
                    size += one.size()
            if size > HELD:
                yield rows()
                held.clear()
                size = 0
        yield rows()

    def merged(frame: pd.DataFrame) -> Wrapper:
        whole = None
        for packed in sorted(frame["wrapper"]):
            one = Wrapper.unpack(packed)
            if whole is None:
                whole = one
            else:
                whole.merge(one)
        return whole

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [key[0]], "layout": [key[1]], "wrapper": [merged(frame).pack()]})

    def finish(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        path, constants = merged(frame).places()
        return pd.DataFrame({"host": [key[0]], "layout": [key[1]], "path": [path], "constants": [constants]})

    parts = plain.filter("html <> ''").select("host", "html").mapInPandas(
        partial, "host string, layout long, part int, wrapper binary")
    halfway = parts.groupBy("host", "layout", "part").applyInPandas(merge, "host string, layout long, wrapper binary")
    return halfway.groupBy("host", "layout").applyInPandas(
        finish, "host string, layout long, path array<string>, constants array<string>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", _host("url").alias("host"))
    wrappers = written(wrappers_of(plain), "wrappers")

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            layouts, kept = [], []
            for html in frame["html"]:
                if html:
                    root = raw_tree(html)
                    kept.append(kept_marks(root))
                    layouts.append(layout(_settled(root, kept[-1])))
                else:
                    kept.append(frozenset())
                    layouts.append(None)
            yield frame.assign(layout=pd.array(layouts, "Int64"), kept=[sorted(k) for k in kept])

    described = map_frames(
        plain, "page_id", describe,
        "page_id long, url string, html string, host string, layout long, kept array<int>")
    joined = described.join(wrappers, ["host", "layout"], "left").select("page_id", "url", "html", "kept", "path", "constants")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(h, [] if p is None else list(p), frozenset(() if c is None else c), frozenset(k))
                     for h, p, c, k in zip(frame["html"], frame["path"], frame["constants"], frame["kept"])]
            yield frame[["page_id", "url"]].assign(text=texts, n_chars=list(map(len, texts)))

    return map_frames(joined, "page_id", read, "page_id long, url string, text string, n_chars long")
