"""Text blocks of web pages, with the tag path and text each labeller feature is made from.

One pass over the page finds its tokens, a second one matches the ends of embedded elements, a
third one makes the blocks; each takes time in proportion to the page, however it is malformed.

Defined results for malformed pages: quotes begin values only after an equals sign, and one
that never closes is an ordinary character; a last tag without its end is text; comments,
scripts, styles and text areas that never close run to the end of the page; embedded elements
that never close keep what follows them, and of such a `select` only the options go.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import xxhash

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))"
    r"|<(script|style|textarea)(?=[\s/>])[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
#: Elements whose content is no text of the page.
_EMBEDDED = frozenset("noscript template svg iframe select object".split())
#: What belongs to a list of choices.
_CHOICES = frozenset("option optgroup".split())
#: Elements without content, and elements that stay inside a block of text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var".split()
)
#: Elements that end an open one of the same kind.
_CLOSES = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",),
    "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
}
#: Elements that end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol pre section table ul".split()
)
_LIMITS = frozenset("table ul ol dl article aside section div nav main header footer form body".split())
#: Names that mark main text, and names that mark what is not.
MAIN_NAMES = frozenset("<article <main article main content post entry story".split())
OTHER_NAMES = frozenset(
    "<nav <header <footer <aside <form <button nav navigation menu header footer sidebar aside ad ads advert advertisement "
    "banner cookie consent notice comment comments reply replies social share related promo sponsored breadcrumb widget "
    "popup modal newsletter subscribe login search pagination".split()
)
#: Bins of hashed names.
BINS = 1024


def name_bit(name: str) -> int:
    return 1 << xxhash.xxh32_intdigest(name.encode()) % BINS


class Element:
    """An open element; what labels ask of the whole path is carried down, not gathered again."""

    __slots__ = ("tag", "names", "above", "bits", "main", "other", "head")

    def __init__(self, tag: str, names: tuple[str, ...], above: Element | None) -> None:
        self.tag, self.names, self.above = tag, names, above
        self.bits, self.main, self.other, self.head = (above.bits, above.main, above.other, above.head) if above else (0, False, False, False)
        for name in names:
            self.bits |= name_bit(name)
        self.main = self.main or not MAIN_NAMES.isdisjoint(names)
        self.other = self.other or not OTHER_NAMES.isdisjoint(names)
        self.head = self.head or tag == "head"


@dataclass
class Block:
    """Text of a leaf block, the innermost element around it, the part inside links, where it starts."""

    element: Element | None
    text: str
    linked: int
    at: int

    @property
    def path(self) -> tuple[str, ...]:
        """Names on the path, outermost first."""
        elements, element = [], self.element
        while element:
            elements.append(element)
            element = element.above
        return tuple(name for e in reversed(elements) for name in e.names)


def _embedded_ends(tokens: list[re.Match]) -> dict[int, int]:
    """Number of the token that ends each embedded element, for those that do end."""
    waiting: dict[str, list[int]] = {name: [] for name in _EMBEDDED}
    ends: dict[int, int] = {}
    for k, m in enumerate(tokens):
        tag = m[3].lower() if m[3] else None
        if tag not in _EMBEDDED:
            continue
        if not m[2]:
            if tag == "svg" and m[4].endswith("/"):
                ends[k] = k
            else:
                waiting[tag].append(k)
        elif waiting[tag]:
            ends[waiting[tag].pop()] = k
    return ends


class _Open:
    """The open elements, with the places of each tag and of the limits among them."""

    def __init__(self) -> None:
        self.elements: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.limits: list[int] = []

    def open(self, tag: str, names: tuple[str, ...]) -> None:
        place = len(self.elements)
        self.elements.append(Element(tag, names, self.elements[-1] if self.elements else None))
        self.places.setdefault(tag, []).append(place)
        if tag in _LIMITS:
            self.limits.append(place)

    def close(self, tag: str, within_limits: bool = False) -> None:
        """Close the innermost open element of this tag and what it holds; nothing if a limit is in between."""
        places = self.places.get(tag)
        if not places or (within_limits and self.limits and self.limits[-1] > places[-1]):
            return
        stop = places[-1]
        while len(self.elements) > stop:
            self.places[self.elements.pop().tag].pop()
        while self.limits and self.limits[-1] >= stop:
            self.limits.pop()


def blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order; head, scripts, styles, comments and markup give none."""
    page = page or ""
    out: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    linked = links = first = 0

    def add(start: int, stop: int) -> None:
        nonlocal linked, first
        if stop > start:
            if not parts:
                first = start
            parts.append(page[start:stop])
            if links:
                linked += stop - start

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        element = stack.elements[-1] if stack.elements else None
        if text and not (element and element.head):
            out.append(Block(element, text, linked, first))
        linked = 0

    tokens = list(_TOKEN.finditer(page))
    ends = _embedded_ends(tokens)
    at = k = 0
    choosing = False
    while k < len(tokens):
        m = tokens[k]
        if not choosing:
            add(at, m.start())
        tag = m[3]
        if page[m.end() - 1] != ">" and not m[1] and not page.startswith("<!--", m.start()):
            at = m.start()  # without its end
            break
        at = m.end()
        k += 1
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[2])
        choosing = choosing and tag in _CHOICES
        if tag in _EMBEDDED:
            if k - 1 in ends:
                k = ends[k - 1] + 1
                at = tokens[k - 1].end()
            elif tag == "select" and not closing:
                choosing = True
        elif choosing:
            continue
        elif tag == "br":
            parts.append(" ")
        elif tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
        else:
            flush()
            links = 0
            if closing:
                stack.close(tag)
            else:
                for other in _CLOSES.get(tag, ()):
                    stack.close(other, True)
                if tag in _ENDS_P:
                    stack.close("p", True)
                if tag not in _VOID:
                    found = _NAMES.findall(m[4]) if m[4] else ()
                    words = [w for values in found for v in values for w in _WORD.findall(v.lower())]
                    stack.open(tag, (f"<{tag}", *words))
    if at < len(page) and not choosing:
        add(at, len(page))
    flush()
    return out
