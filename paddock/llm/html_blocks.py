"""The leaf blocks of a page: text and tag path, by one scan over its tags."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements that end a block of text before and after them.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main
menu nav noframes ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr
ul""".split())
#: Elements without content, and elements whose content is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe textarea title".split())
#: A new one of the first ends an open one of the second, up to the third.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: No try goes past the next ``<`` outside quotes and nothing is tried twice, so broken tags cost no more than their length.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Block:
    text: str
    path: tuple
    linked: int
    "Code points of the text inside links."


def _named(attributes: str) -> tuple:
    """The words of an element's class, id and role."""
    if not attributes:
        return ()
    found = [a or b or c for a, b, c in _NAMES.findall(attributes)]
    return tuple(f".{w.lower()}" for f in found for w in _PARTS.findall(f))


class _Scan:
    def __init__(self):
        self.stack: list = []
        self.blocks: list = []
        self.text: list = []
        self.linked = 0
        self.path: tuple | None = None
        self.links = 0

    def add(self, raw: str) -> None:
        if raw and not raw.isspace():
            if self.path is None:
                self.path = tuple(x for s in self.stack for x in s[1])
            if self.links:
                self.linked += len(raw)
        self.text.append(raw)

    def flush(self) -> None:
        if self.path is not None:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                self.blocks.append(Block(text, self.path, min(self.linked, len(text))))
        self.text, self.linked, self.path = [], 0, None

    def pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            name = self.stack.pop()[0]
            self.links -= name == "a"

    def open(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            open_p = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == "p"), None)
            if open_p is not None:
                self.pop_to(open_p)
            if name in ENDS:
                ended, within = ENDS[name]
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i][0] in within:
                        break
                    if self.stack[i][0] in ended:
                        self.pop_to(i)
                        break
        if name == "br":
            self.text.append(" ")
        if name not in VOID and not attributes.endswith("/"):
            self.stack.append((name, (name, *_named(attributes))))
            self.links += name == "a"

    def close(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                self.pop_to(i)
                break
            if self.stack[i][0] in BLOCKS and name not in BLOCKS:
                break


def blocks_of(page: str) -> list[Block]:
    """All blocks of a page in order, whatever their role; broken markup is read as far as it goes."""
    scan, at, silent = _Scan(), 0, None
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        name = (m[2] or m[5] or "").lower()
        if silent:
            if name == silent and (m[1] or m[4]):
                silent, at = None, m.end()
            continue
        scan.add(page[at:m.start()])
        at = m.end()
        if not name:
            continue
        if m[1] or m[4]:
            scan.close(name)
        elif name in SILENT and not (m[3] or m[6] or "").endswith("/"):
            silent = name
        else:
            scan.open(name, m[3] or m[6] or "")
    if not silent:
        scan.add(page[at:])
    scan.flush()
    return scan.blocks
