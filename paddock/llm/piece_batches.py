"""The two best scores and the best segmentation of many short segments at once, in numpy.

The forward pass of :meth:`paddock.llm.piece_lattice.Lattice.search`, of all
segments together and with the two best beginnings per place: that is all a
segment has to say until it is one of the few whose other choices differ in a
text's best, and those are searched backward by A-star.
"""

from __future__ import annotations

import numpy as np

#: Longest segment that is searched here.
LONGEST = 24
#: Characters with a column of their own in the table of transitions.
COLUMNS = 160
_NONE = np.int64(-(1 << 60))


class Batches:
    def __init__(self, known: dict, scores: tuple):
        """``known``: piece text to (score, id)."""
        counts: dict = {}
        for text in known:
            for c in text:
                counts[c] = counts.get(c, 0) + 1
        common = sorted(counts, key=lambda c: (-counts[c], c))[:COLUMNS]
        self.column = {ord(c): k for k, c in enumerate(common)}
        table = np.full(max(self.column, default=0) + 1, -1, np.int16)
        for code, k in self.column.items():
            table[code] = k
        self.codes = table
        nodes = {"": 0}
        for text in sorted(known):
            if all(ord(c) in self.column for c in text):
                for k in range(1, len(text) + 1):
                    nodes.setdefault(text[:k], len(nodes))
        self.next = np.full((len(nodes), len(common) + 1), -1, np.int32)
        self.piece = np.full(len(nodes), -1, np.int32)
        for text, node in nodes.items():
            if text:
                self.next[nodes[text[:-1]], self.column[ord(text[-1])]] = node
                if text in known:
                    self.piece[node] = known[text][1]
        self.scores = np.array(scores + (0,), np.int64)
        self.single = {c for c in common if c in known}

    def fits(self, text: str) -> bool:
        """Whether a segment (spaces as pieces write them) can be searched here."""
        return len(text) <= LONGEST and self.single.issuperset(text)

    def two_best(self, texts: list[str]) -> tuple:
        """Scores, losses of the second choices, ids of all in a row, how many each has."""
        lengths = np.array([len(t) for t in texts])
        n, size = len(texts), int(lengths.max())
        joined = np.frombuffer("".join(t.ljust(size, "\0") for t in texts).encode("utf-32-le"), np.uint32)
        chars = np.where(joined < len(self.codes), self.codes[np.minimum(joined, len(self.codes) - 1)], -1)
        chars = chars.reshape(n, size)
        # per end: scores of the two best beginnings, the last piece of the best and where it starts
        best, second = (np.full((n, size + 1), _NONE, np.int64) for _ in range(2))
        best[:, 0] = 0
        last, start = (np.zeros((n, size + 1), np.int32) for _ in range(2))
        for i in range(size):
            alive = np.flatnonzero(i < lengths)
            node = np.zeros(len(alive), np.int32)
            for j in range(i, size):
                c = chars[alive, j]
                node = np.where(c >= 0, self.next[node, c], -1)
                go = node >= 0
                alive, node = alive[go], node[go]
                if not len(alive):
                    break
                piece = self.piece[node]
                is_piece = piece >= 0
                rows, ids = alive[is_piece], piece[is_piece]
                score = self.scores[ids]
                one, two = best[rows, i] + score, second[rows, i] + score
                held = best[rows, j + 1]
                best[rows, j + 1] = np.maximum(held, one)
                second[rows, j + 1] = np.maximum(np.maximum(second[rows, j + 1], two), np.minimum(held, one))
                # equal scores: the longer last piece, which comes first
                more = one > held
                last[rows[more], j + 1], start[rows[more], j + 1] = ids[more], i
        every = np.arange(n)
        total, other = best[every, lengths], second[every, lengths]
        loss = np.where(other < _NONE // 2, Segments.ALONE, total - other)
        return total, loss, *self._ids(lengths, last, start)

    @staticmethod
    def _ids(lengths, last, start) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all best segmentations in a row, and how many each has."""
        n, size = last.shape[0], last.shape[1] - 1
        ids, depth = np.zeros((n, size), np.int32), np.zeros(n, np.int64)
        end, rows = lengths.copy(), np.arange(n)
        while len(rows):
            depth[rows] += 1
            ids[rows, size - depth[rows]] = last[rows, end[rows]]
            end[rows] = start[rows, end[rows]]
            rows = rows[end[rows] > 0]
        return ids[np.arange(size) >= size - depth[:, None]], depth


class Segments:
    """Segments that were searched, as numbers in arrays: score, loss of the second choice, ids.

    Beyond ``most`` the half that was not met for longest goes.
    """

    #: Stands for the loss where there is no second choice.
    ALONE = np.int64(1 << 62)

    def __init__(self, most: int):
        self.most, self.now = most, 0
        self._start([])

    def _start(self, names: list[str]) -> None:
        self.names = names
        self.index = {part: k for k, part in enumerate(names)}
        if not names:
            self.scores = self.losses = self.begins = self.sizes = self.met = np.zeros(0, np.int64)
            self.ids = np.zeros(0, np.int32)

    def __getitem__(self, part: str) -> tuple:
        k = self.index[part]
        loss, at = self.losses[k], self.begins[k]
        return (int(self.scores[k]), None if loss == self.ALONE else int(loss),
                self.ids[at:at + self.sizes[k]].astype("<i4").tobytes(), part)

    def add(self, names: list[str], scores, losses, ids, sizes) -> None:
        """``ids`` of all segments in a row, ``sizes`` how many each has."""
        sizes = np.asarray(sizes, np.int64)
        ends = len(self.ids) + np.cumsum(sizes)
        self.index.update(zip(names, range(len(self.names), len(self.names) + len(names))))
        self.names += names
        self.scores = np.concatenate([self.scores, np.asarray(scores, np.int64)])
        self.losses = np.concatenate([self.losses, np.asarray(losses, np.int64)])
        self.begins, self.sizes = np.concatenate([self.begins, ends - sizes]), np.concatenate([self.sizes, sizes])
        self.met = np.concatenate([self.met, np.full(len(names), self.now)])
        self.ids = np.concatenate([self.ids, np.asarray(ids, np.int32)])

    def shrink(self) -> None:
        if len(self.names) <= self.most:
            return
        kept = np.sort(np.argsort(-self.met, kind="stable")[:self.most // 2])
        ids, ends = self.gathered(kept)
        for name in ("scores", "losses", "sizes", "met"):
            setattr(self, name, getattr(self, name)[kept])
        self.begins, self.ids = ends - self.sizes, ids
        self._start([self.names[k] for k in kept.tolist()])

    def places(self, names: list[str]) -> np.ndarray:
        """Where the named segments are, all of which are known."""
        at = np.fromiter(map(self.index.__getitem__, names), np.int64, len(names))
        self.met[at] = self.now
        return at

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some segments one after the other, and where each one's end."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.begins[at] - (ends - sizes), sizes) + np.arange(total)], ends
