"""HTML as blocks of text: one pass over tags, with what each block stands in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Element names of the HTML standard.
RAW = frozenset("script style noscript template iframe object svg math canvas textarea select option title head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An end tag may be left out: these end where another of them begins.
IMPLIED = {
    "p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<cut>/?[a-zA-Z][\w:-]*)[^>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")


@dataclass(slots=True)
class Block:
    """One line of text, the share of it inside links, and the open elements around it."""

    text: str
    linked: int
    around: tuple[tuple[str, str], ...]


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; scripts, styles, comments and titles are gone.

    A block ends where an element that is not inline begins or ends. Character
    references are decoded after tags are cut, runs of white space become one space, and
    empty blocks go. ``around`` holds ``(name, marks)`` of the open elements, outermost
    first, where ``marks`` joins class, id, role and the like in lower case. Tags that
    never close, close twice or are cut off at the end do no harm.
    """
    found: list[Block] = []
    open_: list[tuple[str, str]] = []
    parts: list[str] = []
    links: list[str] = []
    in_link = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, len("".join(html.unescape("".join(links)).split())), tuple(open_)))
        parts.clear()
        links.clear()

    at = 0
    for token in TOKEN.finditer(page):
        if token.start() > at:
            parts.append(page[at: token.start()])
            if in_link:
                links.append(parts[-1])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append("\n")
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if token["end"] else 1
            continue
        flush()
        if token["end"]:
            in_link = 0
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    break
            continue
        if name in VOID or token["attributes"].endswith("/"):
            continue
        if name in IMPLIED and open_ and open_[-1][0] in IMPLIED[name]:
            open_.pop()
        marks = " ".join(
            v.strip("\"'") for k, v in ATTRIBUTE.findall(token["attributes"])
            if k.lower() in ("class", "id", "role", "itemprop", "aria-label", "hidden")
        ).lower() if token["attributes"] else ""
        open_.append((name, marks))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return found
