"""A bidirectional LSTM over the blocks of a page, in numpy.

Every block is a vector: its tag path (elements, words of class, id and role)
and its words, hashed, and a few numbers.  One LSTM reads the blocks forwards,
one backwards; a logistic layer on both states labels each block as main text
or not, so every decision sees the whole page.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, fields

import numpy as np

from paddock.llm.html_blocks import Block
from paddock.llm.shingles import word_hashes

PATHS, WORDS, NUMBERS, HIDDEN = 256, 32, 7, 24
INPUTS = PATHS + WORDS + NUMBERS
EPOCHS, BATCH, RATE = 12, 32, 0.01
#: Blocks in one padded batch when labelling.
PADDED = 40_000
_SLOTS: dict = {}


def _slots(part: str) -> tuple:
    """The two places of a path's part; parts are few, their places are kept."""
    found = _SLOTS.get(part)
    if found is None:
        if len(_SLOTS) > 50_000:
            _SLOTS.clear()
        h = zlib.crc32(part.encode("utf-8", "surrogatepass"))
        found = _SLOTS[part] = (h % PATHS, (h >> 16) % PATHS)
    return found


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block; words are counted over the whole text of each."""
    n = len(blocks)
    out = np.zeros((n, INPUTS), np.float32)
    for i, b in enumerate(blocks):
        row = out[i]
        for part in b.path:
            x, y = _slots(part)
            row[x] = row[y] = 1
    joined = np.frombuffer("\n".join(b.text for b in blocks).encode("utf-8", "surrogatepass"), np.uint8)
    hashes = word_hashes(joined)
    blank = (joined == 32) | (joined == 10)
    starts = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)) == -1)
    line = np.cumsum(joined == 10)[starts]
    words = min(len(hashes), len(line))
    counts = np.bincount(line[:words] * WORDS + (hashes[:words] % np.uint64(WORDS)).astype(np.int64),
                         minlength=n * WORDS).reshape(n, WORDS)
    per = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out[:, PATHS:PATHS + WORDS] = counts / per
    size = np.array([len(b.text) for b in blocks], np.float32)
    tail = out[:, PATHS + WORDS:]
    tail[:, 0] = np.log1p(size) / 6
    tail[:, 1] = np.array([b.linked for b in blocks]) / size
    tail[:, 2] = np.array([b.text[-1] in ".!?…:;" for b in blocks])
    tail[:, 3] = np.log1p(per[:, 0]) / 5
    tail[:, 4] = np.array([len(b.path) for b in blocks]) / 10
    tail[:, 5] = np.arange(n) / max(n - 1, 1)
    tail[:, 6] = 1
    return out


@dataclass
class Labeller:
    wf: np.ndarray
    uf: np.ndarray
    wb: np.ndarray
    ub: np.ndarray
    out: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 11) -> Labeller:
        r = np.random.RandomState(seed)

        def one():
            w = r.normal(0, 0.1, (INPUTS, 4 * HIDDEN))
            w[-1, HIDDEN:2 * HIDDEN] = 1  # the last input is 1: gates forget little at first
            return w.astype(np.float32), r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)

        wf, uf = one()
        wb, ub = one()
        return cls(wf, uf, wb, ub, np.zeros(2 * HIDDEN + 1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def _read(self, x, w, u, mask):
        """States of one LSTM over time-first inputs; padding leaves a state as it is."""
        steps, batch = x.shape[:2]
        h = np.zeros((batch, HIDDEN), np.float32)
        c = np.zeros_like(h)
        kept, states = [], np.zeros((steps, batch, HIDDEN), np.float32)
        into = (x.reshape(-1, INPUTS) @ w).reshape(steps, batch, -1)
        for t in range(steps):
            z = into[t] + h @ u
            s = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            new = f * c + i * g
            th = np.tanh(new)
            m = mask[t][:, None]
            kept.append((h, c, i, f, o, g, th))
            c = np.where(m, new, c)
            h = np.where(m, o * th, h)
            states[t] = h
        return states, kept

    def forward(self, x, mask):
        """Scores, time first, for padded pages."""
        a, ka = self._read(x, self.wf, self.uf, mask)
        b, kb = self._read(x[::-1], self.wb, self.ub, mask[::-1])
        states = np.concatenate([a, b[::-1]], axis=2)
        return states @ self.out[:-1] + self.out[-1], (states, ka, kb)

    def _back(self, x, mask, kept, u, d):
        """Gradients of one LSTM from the gradients of its states."""
        steps, batch = x.shape[:2]
        all_dz = np.zeros((steps, batch, 4 * HIDDEN), np.float32)
        dh = np.zeros(d.shape[1:], np.float32)
        dc = np.zeros_like(dh)
        for t in range(steps - 1, -1, -1):
            _, c, i, f, o, g, th = kept[t]
            m = mask[t][:, None]
            total = dh + d[t]
            dn = np.where(m, dc + total * o * (1 - th * th), 0)
            dz = all_dz[t]
            np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f),
                            np.where(m, total * th * o * (1 - o), 0), dn * i * (1 - g * g)], axis=1, out=dz)
            dh = np.where(m, dz @ u.T, total)
            dc = np.where(m, dn * f, dc)
        flat = all_dz.reshape(-1, 4 * HIDDEN)
        before = np.stack([k[0] for k in kept]).reshape(-1, HIDDEN)
        return x.reshape(-1, INPUTS).T @ flat, before.T @ flat

    def gradients(self, x, mask, y):
        scores, (states, ka, kb) = self.forward(x, mask)
        d = (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - y) * mask / max(mask.sum(), 1)
        ds = (d[:, :, None] * self.out[:-1]).astype(np.float32)
        gf = self._back(x, mask, ka, self.uf, ds[:, :, :HIDDEN])
        gb = self._back(x[::-1], mask[::-1], kb, self.ub, ds[::-1, :, HIDDEN:])
        flat = states.reshape(-1, 2 * HIDDEN)
        return [*gf, *gb, np.append(flat.T @ d.ravel(), d.sum()).astype(np.float32)]


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), INPUTS), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, True
    return x, mask


def fit(pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 11) -> Labeller:
    model = Labeller.fresh(seed)
    first = [np.zeros_like(p) for p in model.parts()]
    second = [np.zeros_like(p) for p in model.parts()]
    draw, step = np.random.RandomState(seed), 0
    for epoch in range(EPOCHS):
        # pages of about the same length share a batch
        order = np.argsort([len(p) + draw.random_sample() * 8 for p in pages], kind="stable")
        starts = draw.permutation(np.arange(0, len(order), BATCH))
        for a in starts:
            pick = order[a:a + BATCH]
            x, mask = padded([pages[i] for i in pick])
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(pick):
                y[:len(labels[i]), k] = labels[i]
            step += 1
            for p, g, u, v in zip(model.parts(), model.gradients(x, mask, y), first, second):
                u += 0.1 * (g - u)
                v += 0.001 * (g * g - v)
                p -= RATE * (1 - epoch / EPOCHS) * (u / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def label(model: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Which blocks of each page are main text."""
    out: list = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        take = 1
        while at + take < len(order) and take < 256 and (take + 1) * len(pages[order[at + take]]) <= PADDED:
            take += 1
        pick = order[at:at + take]
        scores, _ = model.forward(*padded([pages[i] for i in pick]))
        for k, i in enumerate(pick):
            out[i] = scores[:len(pages[i]), k] > 0
        at += take
    return out
