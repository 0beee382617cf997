"""A log-bilinear model of token classes, trained in numpy by noise-contrastive estimation.

The next class is predicted from the last ``CONTEXT`` ones: their vectors, each
weighted by its distance, add up to a vector whose products with every class,
plus that class's bias, are the class scores.  Classes that follow each other
are a group, about as many groups as classes in each (:func:`group_size`), and
groups have vectors of their own.  Training tells the true next class, and
the true next group, from noise drawn by frequency and shared by some targets, so one
step is a few matrix products, needs no normalisation and changes only the classes
it meets (and the groups, which are few).  It reads texts in runs of positions, where
a class is looked up once for all contexts it is in.  Scoring normalises exactly on
two levels: the group among all groups, the class among those of its group, so a
token costs the square root of the classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

CONTEXT, DIM, NOISE, BATCH = 5, 16, 64, 4096
RATE, FIRST = 0.15, 1e-5
#: Targets of a run, positions that follow each other; targets that share their noise.
RUN, SHARED = 32, 1024
#: Rows that come more often are summed each for itself.
OFTEN = 5
HALF = np.float32(0.5)
#: How often a group that is not drawn counts as noise, instead of a division by zero.
NEVER = np.float32(2 ** -20)
#: Runs that are scored at once, and rows whose scores stay in a processor's cache.
TOGETHER, CACHED = 2048, 1024


def group_size(classes: int) -> int:
    """How many classes a group has; class ``c`` is in group ``c // size``."""
    return math.isqrt(max(classes - 1, 0)) + 1


@dataclass
class Model:
    """``start``, the class in front of a text, has the last input vector; the last
    column of ``outputs`` (classes) and ``groups`` is a bias."""

    inputs: np.ndarray
    weights: np.ndarray
    outputs: np.ndarray
    groups: np.ndarray

    @classmethod
    def fresh(cls, frequencies: np.ndarray, seed: int = 1) -> Model:
        """Predicts the frequencies whatever the context."""
        draw = np.random.RandomState(seed)
        size = len(frequencies)
        inputs = draw.normal(0, 0.1, (size + 1, DIM))
        outputs, groups = (np.column_stack([draw.normal(0, 0.1, (len(f), DIM)), np.log(f)])
                           for f in (frequencies, _by_group(frequencies)))
        return cls(*(p.astype(np.float32) for p in (
            inputs, np.full((CONTEXT, DIM), 1 / CONTEXT), outputs, groups)))

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.weights, self.outputs, self.groups]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for p in self.parts():
            out.append(np.asarray(flat[at:at + p.size], np.float32).reshape(p.shape))
            at += p.size
        return Model(*out)

    def meaning(self, vectors: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Of the targets of runs, by the vectors of their classes (a row per place) and :meth:`spread`;
        a last column of ones goes with the biases."""
        many = len(vectors) - CONTEXT
        total = vectors[CONTEXT - 1:][:many] * spread[0]
        part = np.empty_like(total)
        for j in range(1, CONTEXT):
            total += np.multiply(vectors[CONTEXT - 1 - j:][:many], spread[j], out=part)
        out = np.ones((total.size // DIM, DIM + 1), np.float32)
        out[:, :DIM] = total.reshape(-1, DIM)
        return out

    def spread(self, runs: int) -> np.ndarray:
        """Per distance, the last class first, the weights as often as there are runs."""
        return np.tile(self.weights, runs)

    def log_probabilities(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """The natural log-probability of each target after its context, normalised over all classes."""
        return self.log_probabilities_of(np.column_stack([contexts[:, ::-1], targets]))

    def log_probabilities_of(self, runs: np.ndarray) -> np.ndarray:
        """The same for all targets of runs (:func:`runs_of`) in their order."""
        return np.concatenate([np.zeros(0)] + [
            self._scored(runs[a:a + TOGETHER]) for a in range(0, len(runs), TOGETHER)])

    def _scored(self, runs: np.ndarray) -> np.ndarray:
        found = runs[:, CONTEXT:].ravel()
        real = np.flatnonzero(found != len(self.outputs))
        meaning = self.meaning(self.inputs.take(runs.T, axis=0).reshape(runs.shape[1], -1), self.spread(len(runs)))
        meaning = meaning.reshape(-1, len(runs), DIM + 1).swapaxes(0, 1).reshape(-1, DIM + 1)
        found, meaning = found[real], meaning.take(real, axis=0)
        size = group_size(len(self.outputs))
        group = found // size
        logs = _log_shares(self.groups, meaning, group)
        order = _sorted(group)
        ends = np.cumsum(np.bincount(group, minlength=len(self.groups))).tolist()
        begin = 0
        for g, end in enumerate(ends):
            if end > begin:
                some = order[begin:end]
                members = self.outputs[g * size:(g + 1) * size]
                logs[some] += _log_shares(members, meaning.take(some, axis=0), found[some] - g * size)
                begin = end
        return logs


def _by_group(frequencies: np.ndarray) -> np.ndarray:
    return np.add.reduceat(frequencies, np.arange(0, len(frequencies), group_size(len(frequencies))))


def _log_shares(members: np.ndarray, meaning: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The log of the picked member's share for each row of ``meaning``, among all members."""
    out = np.empty(len(picked), np.float64)
    for a in range(0, len(picked), CACHED):
        scores = members @ meaning[a:a + CACHED].T
        scores -= scores.max(axis=0)
        own = scores[picked[a:a + CACHED], np.arange(scores.shape[1])].astype(np.float64)
        out[a:a + CACHED] = own - np.log(np.exp(scores, out=scores).sum(axis=0))
    return out


def runs_of(texts: list[np.ndarray], start: int) -> np.ndarray:
    """All positions of some texts in their order, ``RUN`` targets a row behind the ``CONTEXT`` classes before
    them.  ``start`` stands in front of texts and after the last; it is no target."""
    pad = np.full(CONTEXT, start, np.int64)
    size = sum(len(t) + CONTEXT for t in texts)
    joined = [x for t in texts for x in (pad, t)]
    joined = np.concatenate([*joined, np.full(CONTEXT + (-size % RUN if size else RUN), start, np.int64)])
    return np.lib.stride_tricks.sliding_window_view(joined, CONTEXT + RUN)[::RUN]


class Trainer:
    """Adagrad over batches (rare classes keep their pace and do not run on without new
    gradients); gradients of a vector that many rows share are summed, and only such vectors change."""

    def __init__(self, model: Model, frequencies: np.ndarray, seed: int):
        self.model = model.like(model.flat().copy())
        self.draw = np.random.RandomState(seed)
        self.size = group_size(len(frequencies))
        self.levels = [(np.cumsum(f), np.log(NOISE * f).astype(np.float32))
                       for f in (frequencies, _by_group(frequencies))]
        self.squares = [np.full_like(p, FIRST) for p in self.model.parts()]
        self.drawn: list = []
        self.buffers: dict = {}

    def step(self, runs: np.ndarray) -> None:
        """One change by the mean gradient of the targets of runs; noise is drawn for each ``SHARED`` of them."""
        each = max(SHARED // RUN, 1)
        drawn = [self.noise() for _ in range(0, len(runs), each)]
        for p, squares, (rows, grads) in zip(self.model.parts(), self.squares, self._mean(runs, each, drawn)):
            self._ascend(p, squares, rows, grads)

    def gradients(self, contexts: np.ndarray, targets: np.ndarray, drawn: list | None = None) -> list:
        """For each part of the model the rows that have a gradient, and the gradients; ``drawn`` is the noise."""
        runs = np.column_stack([contexts[:, ::-1], targets])
        return self._mean(runs, len(runs), [self.noise() if drawn is None else drawn])

    def _mean(self, runs: np.ndarray, each: int, drawn: list) -> list:
        classes, sums, at, spread = [], [0, 0, 0], 0, self.model.spread(each)
        values = self._kept("values", runs.size + len(drawn) * NOISE, 2 * DIM + 1)
        for k, noise in enumerate(drawn):
            some = runs[k * each:(k + 1) * each]
            size = some.size + NOISE
            # by places, then runs: what lies a distance before the targets is one block
            places = some.T.ravel()
            found = self._piece(places, spread[:, :len(some) * DIM], noise, values[at:at + size])
            sums = [x + y for x, y in zip(sums, found)]
            classes += [places, noise[0]]
            at += size
        weights, groups, n = sums
        rows, total = _summed(np.concatenate(classes), values)
        scale = HALF / np.float32(max(n, 1))
        total *= scale
        known = len(rows) - (rows[-1] == len(self.model.outputs))
        return [(rows, total[:, :DIM]), (slice(None), weights * scale), (rows[:known], total[:known, DIM:]),
                (slice(None), groups * scale)]

    def _piece(self, classes: np.ndarray, spread: np.ndarray, drawn: list, values: np.ndarray) -> tuple:
        """Twice the summed gradients of some runs: of the distances' weights and of all groups, and the number of
        targets.  ``values`` takes those by class, columns of input and output vectors, then those of the noise."""
        m, start, size = self.model, len(self.model.outputs), len(classes)
        many = spread.shape[1] // DIM
        vectors = m.inputs.take(classes, axis=0).reshape(-1, many * DIM)
        meaning = m.meaning(vectors, spread)
        true = classes[CONTEXT * many:]
        none = np.flatnonzero(true == start)
        if len(none):
            true = np.minimum(true, start - 1)
            meaning[none] = 0
        # The noise classes and all groups, as often as drawn, go through the same products; their base comes in by
        # the bias.  A sigmoid is (1 + tanh(x / 2)) / 2: factors go to the small matrices, the ones to their sums.
        other = np.concatenate([m.outputs.take(drawn[0], axis=0), m.groups])
        lowered = other * HALF
        lowered[:, DIM] -= np.concatenate([self.levels[0][1].take(drawn[0]), self.levels[1][1]]) * HALF
        times = np.ones(len(other), np.float32)
        times[NOISE:] = np.maximum(np.bincount(drawn[1], minlength=len(m.groups)), NEVER)
        other *= -times[:, None]
        down = np.matmul(meaning, lowered.T, out=self._kept("down", len(meaning), len(other)))
        np.tanh(down, out=down)
        own = true // self.size
        at = np.arange(NOISE, down.size, len(other)) + own
        up = down.take(at)
        down.ravel()[at] = up - (1 - up) / times.take(NOISE + own)
        vector = m.outputs.take(true, axis=0)
        up = np.einsum("nd,nd->n", meaning, vector)
        up -= self.levels[0][1].take(true)
        up *= HALF
        up = np.subtract(1, np.tanh(up, out=up), out=up)
        if len(none):
            down[none], up[none] = -1, 0
        up = up[:, None]
        g_meaning = down @ other
        g_meaning += other.sum(axis=0)
        g_other = down.T @ meaning
        g_other += np.ones(len(meaning), np.float32) @ meaning
        g_other *= -times[:, None]
        vector *= up
        g_meaning += vector
        g = np.ascontiguousarray(g_meaning[:, :DIM]).reshape(-1, many * DIM)
        g_vectors, g_weights, part = np.zeros_like(vectors), [], np.empty_like(g)
        for j in range(CONTEXT):
            here = slice(CONTEXT - 1 - j, CONTEXT - 1 - j + len(g))
            g_vectors[here] += np.multiply(g, spread[j], out=part)
            g_weights.append(np.einsum("nd,nd->d", g, vectors[here]))
        values[:size, :DIM] = g_vectors.reshape(-1, DIM)
        values[size:, :DIM] = 0
        values[:CONTEXT * many, DIM:] = 0
        np.multiply(meaning, up, out=values[CONTEXT * many:size, DIM:])
        values[size:, DIM:] = g_other[:NOISE]
        return np.stack(g_weights).reshape(CONTEXT, -1, DIM).sum(axis=1), g_other[NOISE:], len(true) - len(none)

    def _kept(self, name: str, rows: int, columns: int) -> np.ndarray:
        """The same memory in every step, as fresh pages cost more than what is written to them."""
        if name not in self.buffers or self.buffers[name].size < rows * columns:
            self.buffers[name] = np.empty(rows * columns, np.float32)
        return self.buffers[name][:rows * columns].reshape(rows, columns)

    def noise(self) -> list[np.ndarray]:
        """``NOISE`` classes and ``NOISE`` groups by their frequencies, one from each equal share of the whole
        (each as likely as if drawn alone, and less left to chance)."""
        if not self.drawn:
            shares = (np.arange(NOISE) + self.draw.random_sample((2, 64, NOISE))) / NOISE
            self.drawn = list(zip(*(np.minimum(np.searchsorted(c, x * c[-1]), len(c) - 1)
                                    for x, (c, _) in zip(shares, self.levels))))
        return self.drawn.pop()

    @staticmethod
    def _ascend(p, squares, rows, g) -> None:
        b = g * g
        b += squares[rows]
        squares[rows] = b
        g = g * np.float32(RATE)
        g /= np.sqrt(b, out=b)
        p[rows] += g


def _sorted(numbers: np.ndarray) -> np.ndarray:
    """The order of numbers; those of 16 bits are sorted by digits."""
    return np.argsort(numbers.astype(np.uint16) if numbers.max(initial=0) < 1 << 16 else numbers, kind="stable")


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the sums of their values: rows that come a few times are added up all
    together, first to first, only those that come often each for itself."""
    order = _sorted(rows)
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(first, append=len(rows))
    sums = values.take(order[first], axis=0)
    often = times > OFTEN
    for k in range(1, OFTEN):
        some = np.flatnonzero((times > k) & ~often)
        sums[some] += values.take(order[first[some] + k], axis=0)
    if often.any():
        begin = np.cumsum(times[often]) - times[often]
        sums[often] = np.add.reduceat(values.take(order[np.repeat(often, times)], axis=0), begin, axis=0)
    return ordered[first], sums
