"""A small tolerant HTML reader: block elements, their text blocks and counts.

Block-level elements are nodes; inline elements only add to their block's text
and link counts. Optional end tags are implied (a block start closes an open
paragraph, an item the item before it), end tags without a start are ignored,
an unfinished tag or comment ends the page. Scripts, styles, the head, frames,
templates and form texts have no text. svg and math keep theirs, their own tags
have no meaning, and a tag of the page around them ends one that is not closed.
A quote opens an attribute value only after an equals sign.
"""

from __future__ import annotations

import re
from html import unescape

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark math meta link nobr noscript object picture q rp rt ruby s "
    "samp small source span strike strong sub sup svg time track tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template iframe xmp noembed noframes".split())
FOREIGN = frozenset(("svg", "math"))
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split())
#: Start tag -> open elements that it closes, up to the nearest boundary.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
           "body": ({"head"}, {"html"})}
#: Start tags that leave svg and math.
LEAVES = CLOSES_P | IMPLIED.keys() | frozenset("b big br code em embed i img nobr ruby s small span strong strike sub sup tt u var".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
_ATTR = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL = re.compile(r'data-y="([01])"')
_SPLIT = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """Nodes in page order; ``blocks`` are (node, raw text) in page order."""

    __slots__ = ("tag", "parent", "depth", "attrs", "label", "chars", "links", "stops", "spaces", "blocks")

    def __init__(self) -> None:
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.attrs: list[str] = []
        self.label: list[int] = []
        self.chars: list[int] = []               # own text, link text, stops and commas, spaces
        self.links: list[int] = []
        self.stops: list[int] = []
        self.spaces: list[int] = []
        self.blocks: list[tuple[int, str]] = []

    def add(self, tag: str, parent: int, attrs: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.attrs.append(attrs)
        y = _LABEL.search(attrs) if "data-y" in attrs else None
        self.label.append(int(y[1]) if y else self.label[parent] if parent >= 0 else 0)
        for x in (self.chars, self.links, self.stops, self.spaces):
            x.append(0)
        return len(self.tag) - 1


def words_of(attrs: str) -> list[str]:
    """Lower-case words of the class, id and role attributes."""
    out: list[str] = []
    for m in _ATTR.finditer(attrs):
        out += _SPLIT.findall(_CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower())
    return out


def parse(html: str) -> Page:
    page = Page()
    stack = [page.add("#page", -1, "")]
    names = ["#page"]
    opened: dict[str, int] = {}
    pieces: list[str] = []
    link, head, n, at = 0, False, len(html), 0
    foreign = ""

    def flush() -> None:
        if pieces:
            page.blocks.append((stack[-1], "".join(pieces)))
            pieces.clear()

    def pop_to(k: int) -> None:
        flush()
        for name in names[k:]:
            opened[name] -= 1
        del stack[k:], names[k:]

    def text(s: str) -> None:
        if s and not head:
            node = stack[-1]
            pieces.append(s)
            page.chars[node] += len(s)
            if link:
                page.links[node] += len(s)
            page.stops[node] += s.count(".") + s.count(",")
            page.spaces[node] += s.count(" ")

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        text(html[at:lt])
        nxt = html[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, lt)
        if m is None:
            closing = nxt == "/" and html[lt + 2:lt + 3].isalpha()
            if closing or (nxt.isascii() and nxt.isalpha()):
                end = html.find(">", lt)
                if end < 0:
                    break
                m = re.match(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", html[lt:end + 1])
            if m is None:
                text("<")
                at = lt + 1
                continue
            at = end + 1
        else:
            at = m.end()
        name, attrs = m[2].lower(), m[3]
        if foreign:
            if m[1] and (name == foreign or opened.get(name, 0)) or not m[1] and name in LEAVES:
                foreign = ""
            elif m[1] or attrs.endswith("/") or name not in RAW:
                if m[1] and name == "a":
                    link = 0
                continue
        if m[1]:
            if name == "head":
                head = False
            if name == "a":
                link = 0
            if name in INLINE:
                continue
            if opened.get(name, 0):
                k = len(names) - 1
                while names[k] != name:
                    k -= 1
                pop_to(k)
            else:
                flush()
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}", re.I).search(html, at)
            if end is None and name == "template":
                continue
            if end is None:
                break
            close = html.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        if name in INLINE:
            if name == "a":
                link = 1
            elif name == "br":
                pieces.append("\n") if pieces else None
            elif name in FOREIGN and not attrs.endswith("/"):
                foreign = name
            continue
        flush()
        if name == "head":
            head = True
            continue
        if name == "body":
            head = False
        if name in VOID:
            continue
        if name in CLOSES_P and opened.get("p", 0):
            k = len(names) - 1
            while names[k] != "p":
                k -= 1
            pop_to(k)
        if name in IMPLIED:
            closes, walls = IMPLIED[name]
            k, cut = len(names) - 1, -1
            while k > 0 and names[k] not in walls:
                if names[k] in closes:
                    cut = k
                k -= 1
            if cut > 0:
                pop_to(cut)
        link = 0
        stack.append(page.add(name, stack[-1], attrs))
        names.append(name)
        opened[name] = opened.get(name, 0) + 1
    flush()
    return page


def block_text(raw: str) -> str:
    return " ".join(unescape(raw).split())
