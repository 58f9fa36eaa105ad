"""Leaf blocks of HTML: the runs of inline text between block boundaries,
with the path of open elements above them. Markup errors (unclosed or stray
tags, cut-off pages) only change the paths."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass

# Fixed values of the HTML vocabulary.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s "
    "samp small source span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is never text of the page.
RAW = frozenset("script style template noscript title textarea select svg math iframe object canvas audio video".split())
# An opening tag ends an open element of the same kind, up to the container.
CLOSES = {
    "p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
}
CONTAINER = frozenset("article aside body div dl fieldset figure footer form header main nav ol section table ul blockquote".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


class Element:
    """An open element: its own tokens ("tag", then ".name"s) and the element
    around it. Blocks share their elements, so a page takes memory in
    proportion to its markup however deeply that is nested."""

    __slots__ = ("tag", "tokens", "around", "length", "block_tag", "_counts")

    def __init__(self, tag: str, tokens: tuple[str, ...], around: Element | None):
        self.tag, self.tokens, self.around = tag, tokens, around
        self.length = len(tokens) + (around.length if around else 0)
        self.block_tag = tag if tag not in INLINE else around.block_tag if around else ""
        self._counts: bytes | None = None

    def path(self) -> tuple[str, ...]:
        """The tokens of all elements, outermost first."""
        parts, at = [], self
        while at is not None:
            parts.append(at.tokens)
            at = at.around
        return tuple(x for tokens in reversed(parts) for x in tokens)

    def counts(self, dims: int, most: int) -> bytes:
        """How often each hash bucket occurs along the path, ``most`` at the
        most; of every element found once, from the one around it."""
        open_ones, at = [], self
        while at is not None and at._counts is None:
            open_ones.append(at)
            at = at.around
        held = at._counts if at is not None else bytes(dims)
        for at in reversed(open_ones):
            made = bytearray(held)
            for token in at.tokens:
                b = bucket(token, dims)
                made[b] = min(made[b] + 1, most)
            held = at._counts = bytes(made)
        return held


@dataclass
class Block:
    text: str
    element: Element | None  # innermost open element
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Outermost element first; "tag" and ".name" tokens."""
        return self.element.path() if self.element else ()

    @property
    def path_length(self) -> int:
        return self.element.length if self.element else 0

    @property
    def tag(self) -> str:
        """Innermost block element."""
        return self.element.block_tag if self.element else ""


def names_of(attributes: str) -> tuple[str, ...]:
    """Letter runs of the class, id and role values, as ".name" tokens."""
    if "=" not in attributes:
        return ()
    found = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return tuple("." + part for value in found for part in _PART.findall(value.lower()))


def blocks(page: str | None) -> list[Block]:
    """Blocks in page order: character references decoded, white space runs
    as one space, trimmed, empty ones left out. None is an empty page."""
    page = page or ""
    out: list[Block] = []
    open_tags: list[Element] = []
    # of the open tags: how many of each since the innermost container, then
    # since the one around that, ...; searches that would find nothing end here
    frames: list[Counter] = [Counter()]
    opened: Counter = Counter()
    text: list[str] = []
    state = {"link": 0, "linked": 0}

    def flush():
        joined = " ".join("".join(text).split())
        if joined:
            out.append(Block(joined, open_tags[-1] if open_tags else None, state["linked"]))
        text.clear()
        state["linked"] = 0

    def add(raw):
        if raw:
            piece = html.unescape(raw) if "&" in raw else raw
            text.append(piece)
            if state["link"]:
                state["linked"] += len(piece.strip())

    def push(tag, tokens):
        open_tags.append(Element(tag, tokens, open_tags[-1] if open_tags else None))
        opened[tag] += 1
        frames[-1][tag] += 1
        if tag in CONTAINER:
            frames.append(Counter())
        state["link"] += tag == "a"

    def pop_to(tags):
        """Close elements up to and with the innermost one of ``tags``."""
        while True:
            tag = open_tags.pop().tag
            if tag in CONTAINER:
                frames.pop()
            opened[tag] -= 1
            frames[-1][tag] -= 1
            state["link"] -= tag == "a"
            if tag in tags:
                return

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            flush()
            return out
        add(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if m.group(1):
            if opened[tag]:
                pop_to((tag,))
            continue
        if tag in RAW:
            if not m.group(3).endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID or m.group(3).endswith("/"):
            continue
        ends = CLOSES.get(tag)
        if ends or tag in CONTAINER or tag[0] == "h":
            ends = ends or CLOSES["p"]  # a paragraph holds no block
            while any(frames[-1][t] for t in ends):
                pop_to(ends)
        push(tag, (tag, *names_of(m.group(3))))


def bucket(token: str, dims: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % dims
