"""A forgiving reader of HTML: the tree of elements and the blocks of text in it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title textarea select svg math iframe object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table body html td th article section div".split())
# an open paragraph ends where one of these begins
BREAKS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}


@dataclass
class Node:
    """An element, or a block of text (``tag`` is ``#text``) with the part of it that is links."""

    tag: str
    parent: int
    attrs: dict[str, str] = field(default_factory=dict)
    text: str = ""
    linked: int = 0


def _attributes(source: str) -> dict[str, str]:
    out = {}
    for name, value in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(value.strip("\"'")) if value else "")
    return out


class Markup:
    """What comes next in a page, read forwards once: a search that fails is never made again.

    A tag ends at the first ``>`` outside quotes. Where quotes are not balanced up to the end of the page, from there
    on it ends at the first ``>`` of any kind; a ``<`` without any ``>`` behind it is text.
    """

    def __init__(self, html: str):
        self.html, self.at = html, 0
        self.last = html.rfind(">")
        self.last_cdata = html.rfind("]]>")
        self.quotes = True
        self.unclosed: set[str] = set()

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``; there is one of some kind."""
        here = at
        while self.quotes:
            m = _STOP.search(self.html, here)
            if m is None:
                self.quotes = False
                break
            if m[0] == ">":
                return m.start()
            here = self.html.find(m[0], m.end()) + 1
            if not here:
                self.quotes = False
        return self.html.find(">", at)

    def next(self) -> tuple[str, str, str, str] | None:
        """The text up to the next tag, its kind (``open``, ``close``, ``cdata`` or ``other``), name or content, and attributes."""
        html, start = self.html, self.at
        here = start
        while True:
            here = html.find("<", here)
            if here < 0 or here > self.last and not html.startswith("<!--", here):
                self.at = len(html)
                return (html[start:], "end", "", "") if start < len(html) else None
            text = html[start:here]
            if html.startswith("<!--", here):
                close = html.find("-->", here + 4)
                self.at = close + 3 if close >= 0 else len(html)
                return text, "other", "", ""
            if html.startswith("<![CDATA[", here) and here < self.last_cdata:
                close = html.index("]]>", here + 9)
                self.at = close + 3
                return text, "cdata", html[here + 9:close], ""
            if html[here + 1] in "!?":
                self.at = html.index(">", here) + 1
                return text, "other", "", ""
            close = html[here + 1] == "/"
            name = _NAME.match(html, here + 1 + close)
            if name is None:
                here += 1
                continue
            end = self._tag_end(name.end())
            self.at = end + 1
            return text, "close" if close else "open", name[0].lower(), html[name.end():end]

    def skip(self, tag: str) -> None:
        """Go behind the end of an element whose content is not read; one of raw text without an end takes the rest."""
        raw = tag in _RAW
        pattern = _RAW[tag] if raw else re.compile(rf"</{re.escape(tag)}\s*>", re.I)
        found = None if tag in self.unclosed else pattern.search(self.html, self.at, self.last + 1)
        if found:
            self.at = found.end()
        else:
            self.unclosed.add(tag)
            if raw:
                self.at = len(self.html)


class Open:
    """The open elements, and where those of each tag and those that bound a list or table stand."""

    def __init__(self):
        self.stack, self.places, self.scopes = [0], {}, [0]

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int, nodes: list[Node]) -> None:
        """Close the element at ``place`` and all in it."""
        for node in reversed(self.stack[place:]):
            self.places[nodes[node].tag].pop()
        while self.scopes[-1] >= max(place, 1):
            self.scopes.pop()
        del self.stack[place:]

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these tags; 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def read(html: str) -> list[Node]:
    """Nodes in page order, parents first; node 0 is the page. The time grows with the length of the page.

    Inline elements do not break a block; every other element does. ``br`` is white space. White space in a
    block becomes one space, and blocks without anything else are left out. Tags that
    are left open or closed wrongly do no harm.
    """
    nodes = [Node("#page", -1)]
    held = Open()
    pieces: list[str] = []
    linked, links = 0, 0
    markup = Markup(html)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                nodes.append(Node("#text", held.stack[-1], {}, text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def say(source: str) -> None:
        nonlocal linked
        if source:
            text = unescape(source) if "&" in source else source
            pieces.append(text)
            if links:
                linked += len(text.strip())

    while (found := markup.next()) is not None:
        before, kind, tag, attrs = found
        say(before)
        if kind == "cdata":
            say(tag)
        elif kind == "close":
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE or tag in VOID:
                if tag == "br":
                    pieces.append(" ")
                continue
            flush()
            place = held.last(tag)
            if place:
                held.cut(place, nodes)
                links = 0
        elif kind == "open":
            if tag in SILENT:
                flush()
                if tag in _RAW or tag != "head" and not attrs.rstrip().endswith("/"):
                    markup.skip(tag)
            elif tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    pieces.append(" ")
            elif tag in INLINE:
                links += tag == "a"
            else:
                flush()
                links = 0
                if tag in BREAKS_PARAGRAPH and "p" in (nodes[k].tag for k in held.stack[-2:]):
                    held.cut(held.last("p"), nodes)
                place = held.last(*CLOSES.get(tag, ()))
                if place and place >= held.scopes[-1]:
                    held.cut(place, nodes)
                nodes.append(Node(tag, held.stack[-1], _attributes(attrs) if attrs else {}))
                held.push(tag, len(nodes) - 1)
    flush()
    return nodes
