"""Leaf blocks of an HTML page: the text between block-level tags, with the path of tags above it."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from html import unescape
from typing import NamedTuple

#: Elements that end a line of text. Fixed values of the markup.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without content.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose content is not markup, up to their end tag, and not text of the page.
RAW = frozenset("script style title textarea iframe noembed noframes".split())
#: The same, but shown as it stands.
SHOWN = "xmp"
#: Elements whose text is a block of its own, with them on its path.
OWN = frozenset("template svg object canvas audio video".split())
#: Elements in which ``/>`` ends an element, and only scripts and styles are raw.
FOREIGN = ("svg", "math")
#: An open element that a start tag of one of these ends.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "p": BLOCK - {"option", "optgroup"},
}

#: Elements of a path that describe a block; text is kept at any depth.
DEPTH = 64

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_BARE = re.compile(r"""[^>"']*+""")
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


class Tags:
    """Finds the tags of a page in time linear in its length, whatever the page.

    A tag ends at the first ``>`` outside quotes, or, if there is none because a quote is left open, at the first ``>``. From
    a given opening quote on, the way to the tag's end does not depend on where the tag began; so the quotes from which no end was
    found are remembered, and no later tag goes that way again.
    """

    def __init__(self, html: str):
        self.html, self.last, self.lost = html, html.rfind(">"), set()

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Begin and end of the next tag, comment or declaration, whether it is an end tag, its name (lower case; empty if none) and attributes."""
        html = self.html
        at = html.find("<", at)
        while 0 <= at:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(html), False, "", ""
            if at > self.last:  # no tag ends behind this place
                at = html.find("<!--", at)
                continue
            closing = html.startswith("/", at + 1)
            name = _NAME.match(html, at + 1 + closing)
            if name:
                begin = name.end()
                end = self._end(begin)
                return at, end + 1, closing, name[0].lower(), html[begin:end]
            if html[at + 1 : at + 2] in ("!", "?", "/"):
                return at, html.index(">", at) + 1, False, "", ""
            at = html.find("<", at + 1)
        return None

    def _end(self, begin: int) -> int:
        html, passed, at = self.html, [], begin
        while True:
            at = _BARE.match(html, at).end()
            if at >= len(html) or at in self.lost:
                break
            if html[at] == ">":
                return at
            passed.append(at)
            at = html.find(html[at], at + 1) + 1
            if not at:
                break
        self.lost.update(passed)
        return html.index(">", begin)


class Block(NamedTuple):
    """``path``: names of the (at most :data:`DEPTH` innermost) elements above, outermost first, each a tag with words of its class and id; ``text`` with single
    spaces; ``linked``: how many of its characters stand in links."""

    path: tuple[tuple[str, ...], ...]
    text: str
    linked: int


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (tag,)
    words = [w.lower() for m in _NAMES.finditer(attributes) for w in _PART.findall(m[1] or m[2] or m[3] or "")]
    return (tag, *dict.fromkeys(words))


def blocks(html: str) -> list[Block]:
    """The blocks of the whole page in order, empty ones left out. Markup may be broken: end tags without a start are passed
    over, elements left open end with the one around them, and a ``<`` that begins no tag is text."""
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    text: list[str] = []
    opened: Counter[str] = Counter()
    owners: list[int] = []  # where the open elements of OWN are in the stack
    places: dict[str, list[int]] = defaultdict(list)  # where the open elements of each tag are in the stack
    lines: list[int] = []  # where those of BLOCK are
    held: tuple[int, tuple[tuple[str, ...], ...]] | None = None  # of text in one of OWN: which, and its path
    linked, at, size, tags = 0, 0, len(html), Tags(html)

    def pop() -> None:
        tag = stack.pop()[0]
        places[tag].pop()
        opened[tag] -= 1
        for some in (owners, lines):
            if some and some[-1] == len(stack):
                some.pop()

    def add(piece: str, shown: bool = False) -> None:
        nonlocal linked, held
        if piece:
            if (owners or held) and not piece.isspace():
                if (held[0] if held else -1) != (owners[-1] if owners else -1):
                    flush(len(stack) if held else owners[0])
                held = (owners[-1], tuple(stack[-DEPTH:])) if owners else None
            piece = unescape(piece) if "&" in piece and not shown else piece
            text.append(piece)
            if opened["a"]:
                linked += len(piece)

    def flush(depth: int | None = None) -> None:
        nonlocal linked, held
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                depth = len(stack) if depth is None else depth
                path = held[1] if held else tuple(stack[max(0, depth - DEPTH) : depth])
                out.append(Block(path, joined, linked))
            text.clear()
        linked, held = 0, None

    def raw_end(tag: str) -> tuple[int, int]:
        """Where the content of a raw element ends, and where its end tag does; the end of the page if it has none."""
        found = re.compile(rf"</{re.escape(tag)}\b", re.I).search(html, at)
        end = html.find(">", found.end()) if found else -1
        return (found.start(), end + 1) if end >= 0 else (size, size)

    while at < size:
        found = tags.next(at)
        if found is None:
            add(html[at:])
            break
        add(html[at : found[0]])
        at, closing, tag, attributes = found[1:]
        if not tag:  # a comment or declaration
            continue
        if not closing:
            foreign = tag in FOREIGN or opened["svg"] or opened["math"]
            if tag in RAW and (not foreign or tag in ("script", "style")):
                if not attributes.endswith("/"):
                    at = raw_end(tag)[1]
                continue
            if tag == SHOWN and not foreign:
                flush()
                stack.append(_element(tag, attributes))
                stop, after = raw_end(tag)
                add(html[at:stop], shown=True)
                flush()
                stack.pop()
                at = after
                continue
            if tag in BLOCK:
                flush()
                while stack and stack[-1][0] not in BLOCK and stack[-1][0] not in OWN:  # inline elements left open
                    pop()
                while stack and tag in ENDED_BY.get(stack[-1][0], ()):
                    pop()
            elif tag == "br":
                text.append("\n")
            if tag not in VOID and not (attributes.endswith("/") and (foreign or tag in OWN)):
                if tag in OWN:
                    owners.append(len(stack))
                if tag in BLOCK:
                    lines.append(len(stack))
                places[tag].append(len(stack))
                stack.append(_element(tag, attributes))
                opened[tag] += 1
        elif opened[tag]:
            if tag in BLOCK:
                flush()
            place = places[tag][-1]
            if tag in BLOCK or tag in OWN or not lines or lines[-1] < place:  # else it is not open in this block
                while len(stack) > place:
                    pop()
    flush()
    return out
