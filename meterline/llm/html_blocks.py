"""Leaf blocks of an HTML page: text runs between block-level tags, with the tags and names around them.

Only scripts, styles and the choices and inputs of forms are left out. What stands in any other element is text of some
block, also in elements that browsers show in their own way (formulas, drawings, listings, fallbacks of embedded
objects); an element without an end tag ends with the one around it. Time and memory are linear in the page, whatever
its markup: blocks share what surrounds them, open elements are found by their place, and a tag whose quotes don't
match up to the end of the page is read up to its next ``>`` once that is known.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark math object optgroup option q rp rt ruby s samp select small span strike strong sub sup svg textarea time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Up to the end tag nothing is markup, and nothing is text of the page.
CODE = {tag: re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I) for tag in ("script", "style")}
#: Text in these form controls isn't text of the page.
SILENT = frozenset("select textarea".split())
_LISTING_END = re.compile(r"</xmp(?=[\s/>])", re.I)
#: Everything inside these is part of the line, up to a tag that can't stand there.
FOREIGN = frozenset("svg math".split())
_LEAVES_FOREIGN = frozenset("article aside blockquote body center dd div dl dt footer form h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table td th tr ul".split())
#: An opening tag of these ends an open element of the group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_STOPS = frozenset("ul ol dl table article section main aside nav div body form".split())
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^'\">]+)*+)>", re.S)
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMES = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass(frozen=True)
class Around:
    """What an open element and those around it say. Elements that add nothing share the sets of their parent."""
    tags: frozenset[str]
    names: frozenset[str]   # words of class, id and role
    own: str                # the innermost tag that isn't inline


@dataclass(frozen=True)
class Block:
    text: str               # white space folded
    linked: int             # characters inside links
    around: Around


class _Page:
    def __init__(self, known: frozenset[str] | None):
        self.known, self.out = known, []
        self.stack: list[tuple[str, Around]] = []
        self.places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
        self.parts: list[str] = []
        self.linked = 0
        self.around = Around(frozenset(), frozenset(), "none")

    def is_open(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def last(self, tags: frozenset[str] | set[str]) -> int:
        """Place of the innermost open element of these; -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def first(self, tags: frozenset[str]) -> int:
        """Place of the outermost open element of these."""
        return min(self.places[t][0] for t in tags if self.places.get(t))

    def push(self, tag: str, attributes: str, inline: bool) -> None:
        names = {w.lower() for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[1] or m[2] or m[3] or "")} if "=" in attributes else set()
        tags, above = {tag}, self.around
        if self.known is not None:
            names, tags = names & self.known, tags & self.known
        own = above.own if inline else tag
        if own != above.own or not (names <= above.names and tags <= above.tags):
            self.around = Around(above.tags if tags <= above.tags else above.tags | tags, above.names if names <= above.names else above.names | names, own)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, above))

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag, self.around = self.stack.pop()
            self.places[tag].pop()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.out.append(Block(text, min(self.linked, len(text)), self.around))
        self.parts.clear()
        self.linked = 0

    def say(self, text: str, decode: bool = True) -> None:
        if text and self.last(SILENT) < 0:
            text = unescape(text) if decode else text
            self.parts.append(text)
            if self.is_open("a"):
                self.linked += len(text.strip())

    def close(self, tag: str, inline: bool) -> None:
        if not inline:
            self.flush()
        if self.is_open(tag):
            self.pop_to(self.places[tag][-1])

    def open(self, tag: str, attributes: str, inline: bool) -> None:
        if not inline:
            self.flush()
            if self.is_open("p"):
                self.pop_to(self.places["p"][-1])
            ended = self.last(CLOSES.get(tag, frozenset()))
            if ended >= 0 and ended >= self.last(_STOPS):
                self.pop_to(ended)
        if tag not in VOID and not attributes.endswith("/"):
            self.push(tag, attributes, inline)


def leaf_blocks(html: str, known: frozenset[str] | None = None) -> list[Block]:
    """The blocks of a page in order. Of tags and names around them only ``known`` ones are told, if it is given."""
    page, at, no_tags, plain_until = _Page(known), 0, html.rfind(">") + 1, 0
    listings = html.lower().count("</xmp")
    while (start := html.find("<", at)) >= 0:
        found = _COMMENT.match(html, start)
        if found:
            page.say(html[at:start])
            page.say(found[1] or "", decode=False)
            at = found.end()
            continue
        if start >= no_tags:
            break
        if start >= plain_until:
            found = _TAG.match(html, start)
            if not found and _PLAIN_TAG.match(html, start):
                plain_until = 1 + max(html.rfind('"'), html.rfind("'"))
        found = found or _PLAIN_TAG.match(html, start)
        if not found:  # a mark that begins no tag
            page.say(html[at:start])
            page.say("<")
            at = start + 1
            continue
        page.say(html[at:start])
        at, tag = found.end(), found[2].lower()
        inline, foreign = tag in INLINE, page.last(FOREIGN)
        if foreign >= 0 and not inline:
            if found[1]:  # the end of what stands around the drawing or formula ends that too
                inline = not page.is_open(tag) or page.places[tag][-1] > page.first(FOREIGN)
            elif tag in _LEAVES_FOREIGN:
                page.pop_to(page.first(FOREIGN))
            else:
                inline = True
        if tag == "br":
            page.parts.append(" ")
        elif found[1]:
            page.close(tag, inline)
        elif tag in CODE:
            end = CODE[tag].search(html, at)
            at = end.end() if end else len(html)
        else:
            page.open(tag, found[3], inline)
            if tag == "xmp" and listings and (end := _LISTING_END.search(html, at)):
                page.say(html[at:end.start()], decode=False)
                at, listings = end.start(), listings - 1
    page.say(html[at:])
    page.flush()
    return page.out
