"""Leaf blocks of an HTML page, with their ancestors."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Element groups of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is not parsed (template: parsed, but no part of the page).
RAW = set("script style title textarea xmp template".split())
#: Those whose content is never text of the page.
SILENT = set("script style title template".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input picture audio video map object canvas".split())
#: Elements inside formulas and drawings, which stand in the running text.
INLINE |= set(
    "math annotation maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics"
    " svg circle clippath defs desc ellipse filter g line lineargradient marker mask path pattern polygon polyline radialgradient rect stop symbol text textpath tspan use".split()
)
#: An element on the left ends an open one on the right, up to the stop.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)", re.S)
#: In a tag: its end, or a quote that opens an attribute's value.
IN_TAG = re.compile(r">|=\s*[\"']")
#: Nearest ancestors that a block keeps as its path (all of its text is kept).
PATH = 256
ATTR = re.compile(r"""\b(class|id|role|itemprop|aria-label|style|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


@dataclass(slots=True)
class Block:
    text: str
    #: (tag, names) of each ancestor, outermost first; names: its class, id, role
    path: tuple[tuple[str, str], ...]
    linked: int  # characters inside links


def _names(attrs: str) -> str:
    if not attrs or attrs.isspace():
        return ""
    out = []
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.append("hidden")
        elif key != "style":
            out.append(value)
    return " ".join(out)


def leaf_blocks(page: str) -> list[Block]:
    """Blocks in page order: text between the edges of block-level elements,
    character references decoded, white space as one space, trimmed."""
    stack: list[tuple[str, str]] = []
    opened: Counter = Counter()  # of the tags on the stack
    out: list[Block] = []
    parts: list[str] = []
    path: tuple[tuple[str, str], ...] | None = None
    linked, at, n = 0, 0, len(page)
    quotes, endless = True, set()

    def tag_end(start: int) -> int:
        """Behind the tag's >. In a page with a tag that never ends outside of
        quotes, this tag and all later ones end at their first >: no retries."""
        nonlocal quotes
        k = start
        while quotes:
            m = IN_TAG.search(page, k)
            if m is not None and m[0] == ">":
                return m.end()
            k = page.find(m[0][-1], m.end()) + 1 if m is not None else 0
            quotes = k > 0
        return page.find(">", start) + 1 or n

    def push(tag: str, attrs: str) -> None:
        stack.append((tag, _names(attrs)))
        opened[tag] += 1

    def last(tag: str) -> int:
        """Place of the innermost open ``tag``, -1 if there is none."""
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag) if opened[tag] else -1

    def flush() -> None:
        nonlocal path, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path or (), min(linked, len(text))))
        parts.clear()
        path, linked = None, 0

    def add(raw: str) -> None:
        nonlocal path, linked
        if path is None and not raw.isspace():
            path = tuple(stack[-PATH:])
        parts.append(raw)
        if opened["a"]:
            linked += len(raw)

    def pop_to(k: int) -> None:
        opened.subtract(t for t, _ in stack[k:])
        del stack[k:]

    while (m := TOKEN.search(page, at)) is not None:
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if not m["tag"]:
            continue  # a comment or a declaration
        at = tag_end(m.end())
        tag, attrs = m["tag"].lower(), page[m.end() : at].removesuffix(">")
        if m["end"]:
            if tag == "br":
                add(" ")
            k = last(tag)
            if tag in INLINE:
                if k >= 0 and any(t not in INLINE for t, _ in stack[k + 1 :]):
                    opened[tag] -= 1
                    del stack[k]  # opened outside the current block: only it ends
                elif k >= 0:
                    pop_to(k)
                continue
            flush()
            if k >= 0:
                pop_to(k)
            continue
        if tag in RAW and tag not in endless and not attrs.rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            if close is None:
                endless.add(tag)
            if close is not None or tag in ("script", "style"):
                inner, at = page[at : close.start() if close else n], close.end() if close else n
                if tag not in SILENT:
                    flush()
                    push(tag, attrs)
                    add(inner)
                    flush()
                    pop_to(len(stack) - 1)
                continue
        if tag in ("br", "wbr", "img", "input"):
            add(" " if tag != "wbr" else "")
            continue
        if tag not in INLINE:
            flush()
            if (p := last("p")) >= 0:
                pop_to(p)
            if tag in CLOSES and any(opened[t] for t in CLOSES[tag][0]):
                ends, stop = CLOSES[tag]
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in ends and stack[k][0] not in stop:
                    k -= 1
                if k >= 0 and stack[k][0] in ends:
                    while k > 0 and stack[k - 1][0] in ends:
                        k -= 1
                    pop_to(k)
        if tag not in VOID:
            if not attrs.rstrip().endswith("/") or tag not in INLINE:
                push(tag, attrs)
    if at < n:
        add(page[at:])
    flush()
    return out
