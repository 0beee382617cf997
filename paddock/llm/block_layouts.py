"""Pages with known labels to train the block labeller on.

Real pages give texts and, where their own elements tell (an article or main
element, less what is inside a menu, footer, form and the like), labels.  The
same texts are set again in layouts of many kinds, drawn from element and class
names in common use, whose labels are known by construction.
"""

from __future__ import annotations

import html

import numpy as np

from paddock.llm.html_blocks import Block, blocks_of

MAIN = {"article", "main", ".article", ".main"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "label"}
#: Class words of what is not main text.
ASIDE_WORDS = """nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar banner footer bottom colophon
copyright legal sidebar side aside widget rail related recommended more ad ads advert advertisement adsense sponsor
sponsored promo promotion cookie cookies consent notice notification alert popup modal overlay gdpr newsletter
subscribe subscription signup login form search share sharing social follow comment comments reply replies respond
discussion disqus thread feedback pagination pager tags tag author meta byline toolbar skip""".split()
#: Those of them that stand inside or beside main text most often.
COMMON = "ad ads advert promo sponsored related share social comments newsletter sidebar cookie tags byline".split()
#: Class words of main text.
MAIN_WORDS = """content post entry story text body article main page blog news single hentry prose copy detail
description""".split()
FILLER = "home about news contact more read here terms privacy search login next previous all top".split()


def by_elements(blocks: list[Block]) -> np.ndarray:
    """Labels from the page's own elements; what stands in no main element is not main text."""
    words = {f".{w}" for w in ASIDE_WORDS}
    out = []
    for b in blocks:
        last = max((i for i, p in enumerate(b.path) if p in MAIN), default=None)
        inside = last is not None and not any(p in ASIDE or p in words for p in b.path[last + 1:])
        out.append(inside)
    return np.array(out, bool)


class Layouts:
    def __init__(self, good: list[str], other: list[str], seed: int = 5):
        self.draw = np.random.RandomState(seed)
        self.good = good or [" ".join(FILLER * 4)]
        self.other = other or FILLER

    def _pick(self, items):
        return items[self.draw.randint(len(items))]

    def _chance(self, p: float) -> bool:
        return self.draw.random_sample() < p

    def _text(self, good: bool) -> str:
        # lengths and words overlap between the kinds: the place decides
        mixed = self._chance(0.3)
        text = self._pick(self.good if good != mixed else self.other)
        return html.escape(text if not self._chance(0.15) else " ".join(text.split()[:6]) or "more")

    def _classed(self, words: list[str]) -> str:
        word = self._pick(COMMON if words is ASIDE_WORDS and self._chance(0.4) else words)
        if self._chance(0.4):
            word += self._pick(["-wrap", "-box", "_block", "-inner", "-list", "-1", "Area", "-container", "-section", "-slot", "-unit"])
        if self._chance(0.2):
            word = self._pick(["site", "page", "the", "js", "col", "l"]) + "-" + word
        return f'{self._pick(["class", "class", "id"])}="{word}"'

    def _inner(self, good: bool, n: int) -> str:
        kind = self.draw.randint(6 if good else 4)
        texts = [self._text(good) for _ in range(n)]
        if good:
            if kind <= 2:
                level = self._pick([1, 2, 3])
                head = f"<h{level}>{self._text(True)[:60]}</h{level}>"
                body = "".join(f"<p>{t}</p>" if self._chance(0.9) else f"<p><b>{t}<br>" for t in texts)
                return (head if self._chance(0.6) else "") + body
            if kind == 3:
                return "".join(f"<div>{t}</div>" for t in texts)
            if kind == 4:
                items = "".join(f"<li>{t}</li>" for t in texts[:4])
                return f"<p>{self._text(True)}</p><ul>{items}</ul>" + "".join(f"<p>{t}</p>" for t in texts[4:])
            return "".join(f"<{tag}>{t}</{tag}>" for t in texts
                           for tag in [self._pick(["p", "p", "blockquote", "pre", "h2", "h3", "section"])])
        if kind == 0:
            return "<ul>" + "".join(f'<li><a href="/x">{t}</a></li>' for t in texts) + "</ul>"
        if kind == 1:
            return "".join(f"<p>{t}</p>" for t in texts)
        if kind == 2:
            return "".join(f'<div><a href="#">{t}</a></div>' for t in texts)
        return (f"<h3>{texts[0]}</h3>" if len(texts) > 1 else "") + "".join(
            f"<div><p>{t}</p></div>" for t in texts[1:] or texts)

    def _aside(self) -> str:
        inner = self._inner(False, self.draw.randint(1, 6))
        kind = self.draw.randint(10)
        if kind < 4:
            tag = self._pick(["nav", "header", "footer", "aside", "form"])
            named = " " + self._classed(ASIDE_WORDS) if self._chance(0.3) else ""
            if tag == "form" and self._chance(0.5):
                inner = f"<label>{self._text(False)}</label><input name=q><button>{self._text(False)}</button>"
            elif self._chance(0.25):
                inner = self._text(False)
            return f"<{tag}{named}>{inner}</{tag}>"
        if self._chance(0.25):
            inner = self._text(False)
        tag = self._pick(["div", "div", "section", "ul", "p"]) if kind < 9 else "aside"
        if tag == "ul":
            inner = "".join(f"<li>{self._text(False)}</li>" for _ in range(3))
        if tag == "p":
            inner = self._text(False)
        return f"<{tag} {self._classed(ASIDE_WORDS)}>{inner}</{tag}>"

    def page(self) -> str:
        """A page whose main text is inside an element that no real page has."""
        n = self.draw.randint(1, 14)
        parts = [self._inner(True, max(1, n // 2)), self._inner(True, max(1, n - n // 2))]
        within = self._aside() if self._chance(0.55) else ""
        body = parts[0] + (f"<x-off>{within}</x-off>" if within else "") + parts[1]
        body = f"<x-main>{body}</x-main>"
        kind = self.draw.randint(8)
        if kind < 3:
            body = f"<article>{body}</article>"
        elif kind < 5:
            body = f"<main>{body}</main>"
        else:
            body = f"<div {self._classed(MAIN_WORDS)}>{body}</div>"
        if self._chance(0.25):
            body = f"<div {self._classed(MAIN_WORDS + ['wrapper', 'container', 'layout'])}>{body}</div>"
        if kind < 5 and self._chance(0.3):
            body += self._aside()
        before = "".join(self._aside() for _ in range(self.draw.randint(0, 4)))
        after = "".join(self._aside() for _ in range(self.draw.randint(0, 4)))
        return f"<html><head><title>{self._text(True)[:40]}</title></head><body>{before}{body}{after}</body></html>"

    def labelled(self) -> tuple[list[Block], np.ndarray]:
        blocks, labels = blocks_of(self.page()), []
        for b in blocks:
            labels.append("x-main" in b.path and "x-off" not in b.path)
            b.path = tuple(p for p in b.path if not p.startswith("x-"))
        return blocks, np.array(labels, bool)


def training_pages(pages: list[str], layouts: int = 2500, seed: int = 5):
    """Blocks and labels: the pages whose elements tell, and ``layouts`` drawn ones."""
    out, good, other = [], [], []
    for page in pages:
        blocks = blocks_of(page)
        labels = by_elements(blocks)
        if labels.any():
            out.append((blocks, labels))
        for b, y in zip(blocks, labels):
            (good if y else other).append(b.text[:2000])
    drawn = Layouts(good, other, seed)
    out += [x for x in (drawn.labelled() for _ in range(layouts)) if x[0]]
    return out
