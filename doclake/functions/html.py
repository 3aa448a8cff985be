"""Small HTML text extractor on the standard library parser.

Supports simple selectors: ``tag``, ``.class``, ``tag.class`` and the
descendant combinator (``nav li``). The text of a matched element is the text
of all its descendants with entities decoded, script and style content left
out, ``<br>`` as a space, whitespace runs collapsed to one space and trimmed
(what a DOM ``text()`` gives). Unclosed ``p`` and ``li`` are closed the way
browsers do.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
RAW_TEXT = {"script", "style"}
# Elements whose start closes an open <p> (HTML parsing rules, abridged).
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
            "section", "table", "ul"}
# Block elements: their start separates text by a space, like <br>.
BLOCK = CLOSES_P | {"li", "dd", "dt", "td", "th", "tr", "body", "html", "figure", "figcaption", "caption"}
_WS = re.compile(r"\s+")


def _compound(part: str) -> tuple[str | None, set[str]]:
    bits = part.split(".")
    return (bits[0].lower() or None), {b for b in bits[1:] if b}


def parse_selector(sel: str) -> list[tuple[str | None, set[str]]]:
    return [_compound(p) for p in sel.split()]


def _matches(el: tuple[str, set[str]], comp: tuple[str | None, set[str]]) -> bool:
    tag, classes = comp
    return (tag is None or el[0] == tag) and classes <= el[1]


class _Extractor(HTMLParser):
    def __init__(self, selectors: list[list[tuple[str | None, set[str]]]]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.stack: list[tuple[str, set[str], list[list[str]]]] = []
        self.found: list[list[list[str]]] = [[] for _ in selectors]
        self.raw = 0

    def _selected(self, i: int) -> bool:
        sel = self.selectors[i]
        if not self.stack or not _matches(self.stack[-1][:2], sel[-1]):
            return False
        j = len(sel) - 2
        for el in reversed(self.stack[:-1]):
            if j < 0:
                break
            if _matches(el[:2], sel[j]):
                j -= 1
        return j < 0

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self._text(" ")
            return
        if tag in VOID:
            return
        if tag in CLOSES_P and any(e[0] == "p" for e in self.stack):
            self._close("p")
        if tag in BLOCK:
            self._text(" ")
        if tag == "li" and self.stack and any(e[0] == "li" for e in self.stack):
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in ("ul", "ol"):
                    break
                if self.stack[k][0] == "li":
                    del self.stack[k:]
                    break
        classes = set()
        for k, v in attrs:
            if k == "class" and v:
                classes = set(v.split())
        self.stack.append((tag, classes, []))
        for i in range(len(self.selectors)):
            if self._selected(i):
                buf: list[str] = []
                self.found[i].append(buf)
                self.stack[-1][2].append(buf)
        if tag in RAW_TEXT:
            self.raw += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in RAW_TEXT and self.raw:
            self.raw -= 1
        if tag == "p" and not any(e[0] == "p" for e in self.stack):
            return
        self._close(tag)

    def _text(self, data: str) -> None:
        for el in self.stack:
            for buf in el[2]:
                buf.append(data)

    def handle_data(self, data):
        if not self.raw:
            self._text(data)


def extract(html: str | None, selectors: list) -> list[list[str]]:
    """For each selector (text, or parsed by :func:`parse_selector`), the
    normalised texts of its matches in document order. Raises ``ValueError``
    for a page that the parser rejects."""
    parsed = [parse_selector(s) if isinstance(s, str) else s for s in selectors]
    if html is None:
        return [[] for _ in selectors]
    p = _Extractor(parsed)
    try:
        p.feed(html)
        p.close()
    except (AssertionError, RecursionError) as e:  # how the standard parser reports markup it cannot read
        raise ValueError(f"unreadable markup: {e}") from e
    return [[_WS.sub(" ", "".join(buf)).strip() for buf in found] for found in p.found]
