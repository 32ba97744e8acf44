"""Blocks of text of an HTML page, read leniently: unclosed, stray and cut-off tags are allowed."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

#: Elements of HTML by their role here.
RAW = {"script", "style", "template", "noscript", "svg", "iframe", "object", "canvas", "audio", "video", "textarea", "select", "title", "head"}
#: Those of RAW whose text runs to the page's end if no closing tag follows; of the others only the tag is left out then.
TO_END = {"script", "style", "iframe", "textarea", "title"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: An opening tag of the key ends an open element of the values, up to the nearest of SCOPE.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS |= dict.fromkeys(BLOCK - {"li", "dt", "dd", "tr", "td", "th", "option", "button"}, {"p"})
SCOPE = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "div", "article", "section", "aside", "nav", "header", "footer", "main", "form", "blockquote", "body", "button"}

# a quote opens a value only right after =; elsewhere it is a character like any other
_VALUE = r"=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]++)?"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|=?[^\s/>=]++(?:\s*+{_VALUE})?|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}


@dataclass(slots=True)
class Element:
    name: str
    parent: "Element | None"
    marks: str = ""  # words of class, id and role
    facts: dict = field(default_factory=dict)  # kept by the classifier
    block: "Element | None" = None  # the innermost block element, itself included


@dataclass(slots=True)
class Block:
    text: str
    element: Element  # the innermost block element
    tag: str
    linked: int  # code points within links
    order: int


def _marks(attributes: str) -> str:
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return ""
    out = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role", "itemprop"):
            out.append(value)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            out.append("-hidden-")
    return " ".join(out)


def blocks_of(page: str) -> list[Block]:
    """The page's non-empty blocks in page order: references decoded, white space folded, comments and raw elements left out."""
    root = Element("html", None)
    root.block = root
    open_now: Counter[str] = Counter()  # elements by name, so that a tag without a partner costs no walk
    top, out, pieces = root, [], []
    linked = links = 0
    unclosed: set[str] = set()  # elements of RAW that no closing tag follows

    def flush() -> None:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            own = top.block
            out.append(Block(text, own, own.name, min(linked, len(text)), len(out)))
        pieces, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        pieces.append(text)
        if links:
            linked += len(text)

    def close(one: Element) -> None:
        nonlocal top, links
        while True:
            links -= top.name == "a"
            open_now[top.name] -= 1
            done, top = top is one, top.parent
            if done:
                break

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:  # a closing tag ends the nearest open element of its name; stray ones nothing
            if name in BLOCK:
                flush()
            if not open_now[name]:
                continue
            one = top
            while one.name != name:
                one = one.parent
            close(one)
            continue
        if name in RAW and name != "head":
            if name == "svg" and m[3].endswith("/"):
                continue
            closing = None if name in unclosed else _RAW_END[name].search(page, at)
            if closing:
                at = closing.end()
            elif name in TO_END:
                at = end
            else:
                unclosed.add(name)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in ("html", "head"):
            continue
        if name in BLOCK:
            flush()
            ends, one = ENDS.get(name, ()), top
            if any(open_now[e] for e in ends):
                while one is not root and one.name not in ends and (one.name not in SCOPE):
                    one = one.parent
                if one.name in ends:
                    close(one)
        if m[3].endswith("/") and name not in BLOCK:
            continue
        top = Element(name, top, _marks(m[3]))
        top.block = top if name in BLOCK else top.parent.block
        open_now[name] += 1
        links += name == "a"
    flush()
    return out
