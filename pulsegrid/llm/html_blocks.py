"""Text blocks of a web page: a tolerant reading of tags into leaf blocks with
their tag path."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

#: Elements without an end tag; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stay inside a block; fixed values.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements whose text is never shown as prose; fixed values.
HIDDEN = frozenset("head title script style template noscript iframe object svg math select button textarea datalist audio video canvas".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math".split())
#: An open element of the key is ended by a start tag of the same group.
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDERS = frozenset("ul ol dl table tbody thead tfoot body article section div main aside nav header footer form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
#: One attribute after another: a whole name, and its value if it has one.
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_MARKED = frozenset("class id role".split())
#: Elements that a trailing slash ends at once, and that nest.
_FOREIGN = frozenset("svg math".split())
_PART = re.compile(r"[a-z]+")


class Block:
    """One leaf block: ``text`` with white space folded, ``path`` the feature
    names of the elements around it, and how many characters are links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def _marks(name: str, rest: str) -> tuple[tuple[str, ...], bool]:
    """Feature names of one start tag, and whether it hides its content."""
    out, hidden = [f"t:{name}"], name in HIDDEN
    if "=" in rest or "hidden" in rest:
        for key, a, b, c in _ATTR.findall(rest):
            key, value = key.lower(), (a or b or c).lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                hidden = True
            elif key == "style":
                hidden = hidden or bool(re.search(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", value))
            elif key in _MARKED:
                out += [f"c:{p}" for p in _PART.findall(value)]
    return tuple(out), hidden


def _end_of(html: str, name: str, rest: str, at: int) -> int:
    """Where an element ends whose content is not read as blocks, ``at`` being the
    end of its start tag: at the matching end tag for foreign elements, at the
    next end tag of its name for others, else at the end of the page."""
    if name not in _FOREIGN:
        end = re.compile(rf"</{name}(?![^\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
        return end.end() if end else len(html)
    if rest.rstrip().endswith("/"):
        return at
    depth = 1
    for tag in re.compile(rf"<(/?){name}(?![^\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.I).finditer(html, at):
        if tag[1]:
            depth -= 1
        elif not tag[2].rstrip().endswith("/"):
            depth += 1
        if not depth:
            return tag.end()
    return len(html)


def blocks_of(html: str) -> list[Block]:
    """The non-empty blocks of a page in order. Unclosed, stray and cut-off tags
    are read as far as they go."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []  # name, features, hidden
    parts: list[str] = []
    linked = links = hidden = 0
    opened: Counter = Counter()  # names on the stack: a stray end tag needs no search

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                found.append(Block(text, tuple(m for s in stack for m in s[1]), linked))
            parts.clear()
        linked = 0

    def pop_to(at: int) -> None:
        nonlocal links, hidden
        while len(stack) > at:
            name, _, hides = stack.pop()
            opened[name] -= 1
            links -= name == "a"
            hidden -= hides

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.match(html, at)
        if m is None:
            break
        at = m.end()
        text = m["text"]
        if text is not None:
            if not hidden:
                parts.append(text)
                if links:
                    linked += len(text)
            continue
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1) if opened[name] else -1
            if name not in INLINE:
                flush()
            if depth >= 0:
                pop_to(depth)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        rest = m["rest"] if m["rest"] is not None else m["rest2"] or ""
        if name in _RAW:
            at = _end_of(html, name, rest, at)
            continue
        if name not in INLINE:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or (name in _SIBLINGS and stack[i][0] in _SIBLINGS[name]):
                    pop_to(i)
                    break
                if stack[i][0] in _HOLDERS:
                    break
        if rest.endswith("/") and name not in INLINE and name in ("div", "span", "p"):
            rest = rest[:-1]
        marks, hides = _marks(name, rest)
        stack.append((name, marks, hides))
        opened[name] += 1
        links += name == "a"
        hidden += hides
    flush()
    return found
