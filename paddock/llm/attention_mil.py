"""Multiple-instance learning with gated attention, in numpy: a text is a bag of passages.

Every passage is encoded; attention weights (a tanh and a sigmoid branch, by
softmax over the bag) say how much each counts; the weighted mean gives the
text's score.  Only texts have labels: the weights are learned from them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from paddock.llm.passages import SIZE

HIDDEN, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4


@dataclass
class Attention:
    encode: np.ndarray
    encode_bias: np.ndarray
    tanh: np.ndarray
    gate: np.ndarray
    weigh: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, positive: float = 0.5, seed: int = 3) -> Attention:
        r = np.random.RandomState(seed)
        return cls(r.normal(0, SIZE ** -0.5, (SIZE, HIDDEN)), np.zeros(HIDDEN),
                   r.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)), r.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)),
                   r.normal(0, ATTENTION ** -0.5, ATTENTION), np.zeros(HIDDEN),
                   np.array([np.log(positive / (1 - positive))]))

    def parts(self) -> list[np.ndarray]:
        return list(vars(self).values())

    def forward(self, x: np.ndarray, starts: np.ndarray):
        """Scores of bags that start at the given rows, attention weights, and what learning needs."""
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        h = np.tanh(x @ self.encode + self.encode_bias)
        t, g = np.tanh(h @ self.tanh), _sigmoid(h @ self.gate)
        e = (t * g) @ self.weigh
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return _sigmoid(z @ self.out + self.bias[0]), a, (bag, h, t, g, z)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gradients(m: Attention, x, starts, y, weights):
    p, a, (bag, h, t, g, z) = m.forward(x, starts)
    d = (p - y) * weights / len(y)
    dz = d[:, None] * m.out
    dh = a[:, None] * dz[bag]
    da = (dz[bag] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, starts)[bag])
    dt, dg = de[:, None] * m.weigh * g * (1 - t * t), de[:, None] * m.weigh * t * g * (1 - g)
    dh += dt @ m.tanh.T + dg @ m.gate.T
    dx = dh * (1 - h * h)
    return [x.T @ dx, dx.sum(axis=0), h.T @ dt, h.T @ dg, (de[:, None] * t * g).sum(axis=0),
            z.T @ d, np.array([d.sum()])]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Attention:
    """Adam over shuffled batches of texts; both labels weigh the same in sum."""
    positive = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    model = Attention.fresh(positive, seed)
    if not len(labels):
        return model
    balance = np.where(labels == 1, 1.0, np.sqrt(positive / (1 - positive)))
    first = [np.zeros_like(p) for p in model.parts()]
    second = [np.zeros_like(p) for p in model.parts()]
    draw, step = np.random.RandomState(seed), 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS)
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            x = np.concatenate([bags[i] for i in pick]).astype(np.float32)
            starts = np.cumsum([0] + [len(bags[i]) for i in pick[:-1]])
            step += 1
            for p, g, u, v in zip(model.parts(), _gradients(model, x, starts, labels[pick], balance[pick]),
                                  first, second):
                g = g + DECAY * p
                u += 0.1 * (g - u)
                v += 0.001 * (g * g - v)
                p -= rate * (u / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model
