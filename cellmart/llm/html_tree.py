"""A page's tags as a tree of blocks, whatever is left unclosed."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_SPECIAL = re.compile(r"[>\"']")
_NAME_END = re.compile(r"[\s/>]")
_NAMED = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# fixed values: elements without end tags, elements that are inline, and elements whose content is never text
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe select button object canvas audio video".split())
FOREIGN = frozenset(("svg", "math"))
# formulas and drawings stand in their line
_IN_FOREIGN = frozenset(
    "svg math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover munderover mmultiscripts mprescripts none mspace mstyle"
    " mpadded mphantom menclose mfenced merror maction mtable mtr mlabeledtr mtd semantics annotation annotation-xml g defs desc path text tspan"
    " textpath circle ellipse line polygon polyline rect use symbol marker mask pattern clippath image lineargradient radialgradient stop filter"
    " metadata switch view".split()
)
# what a start tag ends if it is still open, up to the element that holds it
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


@dataclass
class Node:
    """A block element, or an inline one with a class, id or role; ``parent`` comes before it in the list."""

    tag: str
    parent: int
    words: tuple[str, ...] = ()
    chars: int = 0
    linked: int = 0


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=lambda: [Node("#root", -1)])
    # (node, text, whether a block ends before it) in page order
    texts: list[tuple[int, str, bool]] = field(default_factory=list)


def _words(attributes: str) -> tuple[str, ...]:
    found: list[str] = []
    for name, value in _NAMED.findall(attributes):
        if name.lower() == "hidden":
            found.append("hidden")
        found += [w.lower() for w in _PARTS.findall(value)]
    return tuple(dict.fromkeys(found))


def _takes_the_slash(attributes: str) -> bool:
    """Whether the slash at the end belongs to an attribute value without quotes."""
    body = attributes[:-1]
    from_ = max(map(body.rfind, " \t\n\r\f\v\"'")) + 1
    value = body[from_:]
    at = value.find("=")
    return (0 <= at < len(value) - 1) or (bool(value) and body[:from_].rstrip().endswith("="))


class _Next:
    """Where a pattern next occurs at or after a place; places that ascend cost one pass over the page."""

    def __init__(self, page: str, pattern: re.Pattern) -> None:
        self.page, self.pattern = page, pattern
        self.asked, self.found = 0, -1

    def __call__(self, at: int) -> int:
        if not (self.asked <= at and (self.found >= at or self.found == len(self.page))):
            match = self.pattern.search(self.page, at)
            self.asked, self.found = at, match.start() if match else len(self.page)
        return self.found


class _Tags:
    """The tokens of a page from left to right, in time that follows its length whatever is left open.

    A tag ends at the first ``>`` outside quotes; one that has none, since the page or a quote ends first, is text. What is
    found out from a quote or ``>`` on is kept, so no stretch is walked twice.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.special, self.name_end = _Next(page, _SPECIAL), _Next(page, _NAME_END)
        self.known: dict[int, int] = {}
        self.no_end: set[str] = set()

    def end_of(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes start at ``at``, or -1."""
        page, trail, size = self.page, [], len(self.page)
        place = self.special(at)
        while True:
            if place == size:
                end = -1
            elif place in self.known:
                end = self.known[place]
            else:
                trail.append(place)
                if page[place] == ">":
                    end = place
                else:
                    close = page.find(page[place], place + 1)
                    if close >= 0:
                        match = _SPECIAL.search(page, close + 1)
                        place = match.start() if match else size
                        continue
                    end = -1
            break
        self.known.update(dict.fromkeys(trail, end))
        return end

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it closes, name and attributes of the next token from ``at`` on; comments and declarations have no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            first = page[at : at + 1]
            if first in ("!", "?"):
                if page.startswith("!--", at):
                    end = page.find("-->", at + 3)
                    return start, end + 3 if end >= 0 else len(page), False, "", ""
                end = page.find(">", at)
                return start, end + 1 if end >= 0 else len(page), False, "", ""
            closing = first == "/"
            name = at + closing
            if not ("a" <= page[name : name + 1].lower() <= "z" and page[name].isascii()):
                continue
            name_end = self.name_end(name)
            end = self.end_of(name_end)
            if end < 0:
                # a name does not hold a quote that would have to be closed
                name_end = min(name_end, self.special(name))
                end = self.end_of(name_end)
            if end >= 0:
                return start, end + 1, closing, page[name:name_end].lower(), page[name_end:end]
        return None

    def raw_end(self, tag: str, at: int) -> re.Match | None:
        """The end tag of an element without markup inside; that there is none any more is remembered."""
        if tag in self.no_end:
            return None
        match = re.compile(rf"</{tag}\s*>", re.I).search(self.page, at)
        if match is None:
            self.no_end.add(tag)
        return match


class _Open:
    """Open elements with the node that their text belongs to, and where in the stack each name stands."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}

    @property
    def owner(self) -> int:
        return self.stack[-1][1]

    def push(self, tag: str, owner: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, owner))

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.places[self.stack.pop()[0]].pop()

    def last(self, *tags: str) -> int:
        """The innermost place of any of the names, 0 if none is open."""
        return max((places[-1] for t in tags if (places := self.places.get(t))), default=0)

    def holds(self, tags: frozenset[str]) -> bool:
        return any(self.places.get(t) for t in tags)


def parse(page: str) -> Tree:
    """Block elements with their texts, references decoded. Comments, head matter, scripts, styles, controls and
    fallbacks of embedded content carry no text; formulas and labels of drawings do, and ``xmp`` holds text as it stands.

    Time follows the length of the page, also where quotes, tags or elements are never closed."""
    tree = Tree()
    nodes, texts = tree.nodes, tree.texts
    tags, stack = _Tags(page), _Open()
    broken, at = True, 0

    def text(raw: str, decoded: bool = False) -> None:
        nonlocal broken
        if raw and stack.owner >= 0:
            raw = raw if decoded else html.unescape(raw)
            if raw.strip():
                size = len(raw.strip())
                node = nodes[stack.owner]
                node.chars += size
                node.linked += size if stack.places.get("a") else 0
            texts.append((stack.owner, raw, broken))
            broken = False

    while token := tags.after(at):
        start, end, closing, tag, attributes = token
        text(page[at:start])
        at = end
        if not tag:
            continue
        foreign = tag in FOREIGN or stack.holds(FOREIGN)
        inline = tag in INLINE or (foreign and tag in _IN_FOREIGN)
        if tag == "br":
            text(" ")
            continue
        if closing:
            if depth := stack.last(tag):
                stack.cut(depth)
            broken = broken or not inline
            continue
        if foreign and attributes.endswith("/") and not _takes_the_slash(attributes):
            continue
        if tag in RAW:
            found = tags.raw_end(tag, at)
            if found:
                at = found.end()
            elif tag in ("script", "style", "title", "textarea"):
                at = len(page)
            broken = broken or tag not in ("button", "select")
            continue
        if not inline:
            opened, holders = _ENDS.get(tag, (("p",), ()))
            depth = stack.last(*opened, "p")
            if depth > stack.last(*holders):
                stack.cut(depth)
            broken = True
        words = _words(attributes) if "=" in attributes or "hidden" in attributes else ()
        if tag in VOID:
            continue
        owner = stack.owner
        if not inline or words:
            nodes.append(Node(tag, max(owner, 0), words))
            owner = len(nodes) - 1
        stack.push(tag, owner)
        if tag == "xmp":
            found = tags.raw_end("xmp", at)
            text(page[at : found.start() if found else len(page)], decoded=True)
            at = found.end() if found else len(page)
            stack.cut(len(stack.stack) - 1)
            broken = True
    text(page[at:])
    return tree
