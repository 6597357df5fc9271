"""A small HTML reader: elements with parents, and text pieces in page order."""

from __future__ import annotations

import re
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset(("script", "style"))
# Elements that stand at the top themselves.
TOP = frozenset(("html", "head", "body", "frameset"))
INLINE = frozenset(("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp "
                    "small span strong sub sup time tt u var").split())
# A start tag of the key closes an open element of the value.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Where the search for such an element stops.
SCOPE = frozenset(("html body article main section div aside nav header footer ul ol dl table "
                   "form blockquote figure td th").split())
_ATTRS = r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:" + _ATTRS
                     + r"|([^>]*)(?:>|\Z))", re.S)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW}
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """tags, parents (-1 for roots), marks (tokens of class, id and role) and
    raw attributes of the elements; pieces: (element, text) in order, where
    text None is a block boundary. Texts have their references decoded. Text
    and elements outside of any element open an implied body, as browsers
    do, so every text that is not white space has an element."""

    __slots__ = ("tags", "parents", "attrs", "pieces")

    def __init__(self, html: str):
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.attrs: list[str] = []
        self.pieces: list[tuple[int, str | None]] = []
        self._read(html)

    def marks(self, i: int) -> list[str]:
        if not self.attrs[i]:
            return []
        return [t.lower() for v in _MARKS.findall(self.attrs[i]) for t in _TOKEN.findall(v)]

    def _read(self, html: str) -> None:
        pieces = self.pieces
        stack: list[int] = []
        at, size = 0, len(html)
        while at < size:
            m = _MARKUP.search(html, at)
            start = m.start() if m else size
            if start > at:
                text = html[at:start]
                if "&" in text:
                    text = unescape(text)
                if not stack and not text.isspace():
                    self._open(stack, "body", "")
                pieces.append((stack[-1] if stack else -1, text))
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag not in INLINE:
                pieces.append((-1, None))
            if m[1]:
                self._close(stack, tag)
                continue
            if tag not in INLINE:
                self._imply(stack, tag)
            if not stack and tag not in TOP:
                self._open(stack, "body", "")
            self._open(stack, tag, m[3] or m[4] or "")
            if tag in RAW:
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else size
            if tag in RAW or tag in VOID:
                stack.pop()

    def _open(self, stack: list[int], tag: str, attrs: str) -> None:
        self.tags.append(tag)
        self.parents.append(stack[-1] if stack else -1)
        self.attrs.append(attrs)
        stack.append(len(self.tags) - 1)

    def _imply(self, stack: list[int], tag: str) -> None:
        wanted = CLOSES.get(tag, ())
        for k in range(len(stack) - 1, -1, -1):
            open_ = self.tags[stack[k]]
            if open_ == "p" or open_ in wanted:
                del stack[k:]
                return
            if open_ in SCOPE:
                return

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, -1, -1):
            open_ = self.tags[stack[k]]
            if open_ == tag:
                del stack[k:]
                return
            if tag in INLINE and open_ not in INLINE:
                return
            if tag == "p" and open_ in SCOPE:
                return
