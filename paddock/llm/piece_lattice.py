"""N-best SentencePiece segmentation of a text's lattice, in exact integer scores.

A text is a chain of segments: no piece reaches across the border before a
space that follows another character, nor across a character that no piece
holds.  In a segment, Viterbi scores forward from its start are exact heuristics
for an A-star search backward from its end, which hands out segmentations best
first.  The best of a text come from those of its segments: only the ``n - 1``
segments that lose least by their second choice can differ in its ``n`` best.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from paddock.llm.piece_batches import Batches, Segments

SPACE = "▁"
#: Scores are whole millionths of a nat, so sums and ties are exact.
UNIT = 1_000_000
#: Weight of the piece of rank r: 1 / (r + SHIFT).
SHIFT = 2.7
#: Segments a worker keeps, about.
CACHE = 250_000
#: Short segments of like length that are searched at once.
TOGETHER = 2_000


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: per id its text, its bytes when decoded, and its score."""

    texts: tuple
    scores: tuple
    byte_ids: tuple
    unknown: int

    @classmethod
    def load(cls, path: str, ranked: bool = True) -> Pieces:
        """From a SentencePiece file.

        ``ranked``: scores of a BPE file are merge ranks; a rank becomes a log
        probability by Zipf's law (the file holds no counts).  Otherwise they
        are log probabilities already.
        """
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        skip = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        given = [model.get_score(i) for i in range(size)]
        if ranked:
            usual = [-s for s, no in zip(given, skip) if not no and s > -1e8]
            last = max(usual, default=0) + 1
            weights = [1 / ((-s if s > -1e8 and not no else last) + SHIFT) for s, no in zip(given, skip)]
            total = math.log(sum(weights))
            given = [math.log(w) - total for w in weights]
        scores = [round(s * UNIT) for s in given]
        byte_ids = {texts[i]: i for i in range(size) if model.is_byte(i)}
        byte_ids = tuple(byte_ids[f"<0x{b:02X}>"] for b in range(256)) if len(byte_ids) == 256 else ()
        return cls(tuple(None if no else t for t, no in zip(texts, skip)), tuple(scores), byte_ids,
                   model.unk_id())


class Lattice:
    """Segmentations of texts by one vocabulary, with a bounded cache of segments."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known = {t: (pieces.scores[i], i) for i, t in enumerate(pieces.texts) if t}
        self.longest = max(map(len, self.known), default=1)
        #: Every beginning of a piece; what is not here begins none.
        self.begins = {t[:k]: self.known.get(t[:k]) for t in self.known for k in range(1, len(t) + 1)}
        inner = [t for t in self.known if SPACE in t.lstrip(SPACE)]
        if inner:
            raise ValueError(f"pieces that reach across words are not supported: {inner[:3]}")
        self.lowest = min(pieces.scores, default=0)
        self.batches = Batches(self.known, pieces.scores)
        self.cache = Segments(CACHE)
        self.deeper: dict = {}
        self.bytes_of = [(t or "").replace(SPACE, " ").encode() for t in pieces.texts]
        for value, i in enumerate(pieces.byte_ids):
            self.bytes_of[i] = bytes([value])
        self.parts = re.compile(r" *[^ \n]+| +|\n").findall

    def _fallback(self, char: str) -> tuple:
        """The ids and score of a character that is no piece: its bytes, or unknown."""
        ids = self.pieces.byte_ids
        if not ids:
            return (self.pieces.unknown,), self.lowest - 10 * UNIT
        got = tuple(ids[b] for b in char.encode("utf-8", "surrogatepass"))
        return got, sum(self.pieces.scores[i] for i in got)

    def search(self, segment: str) -> Iterator[tuple]:
        """(score, ids) of the segmentations of a segment, best first; ties in a fixed order."""
        text = "".join("\0" if c == SPACE else c for c in segment).replace(" ", SPACE)
        size, begins = len(text), self.begins
        best: list = [None] * (size + 1)
        best[0] = 0
        into: list = [[] for _ in range(size + 1)]
        for i in range(size):
            here = best[i]
            for j in range(i + 1, min(size, i + self.longest) + 1):
                found = begins.get(text[i:j], 0)
                if not found:
                    if j > i + 1:
                        if found is None:
                            continue
                        break
                    ids, score = self._fallback(SPACE if segment[i] == " " else segment[i])
                else:
                    score, ids = found[0], (found[1],)
                into[j].append((i, score, ids))
                if best[j] is None or here + score > best[j]:
                    best[j] = here + score
                if found == 0:
                    break
        # ties: the longer last piece first, then the longer one before it, and so on
        agenda = [(-best[size], (), size, 0, None)]
        while agenda:
            total, sizes, at, done, path = heapq.heappop(agenda)
            if at == 0:
                ids: list = []
                while path:
                    ids.extend(path[0])
                    path = path[1]
                yield -total, tuple(ids)
                continue
            for i, score, ids in into[at]:
                heapq.heappush(agenda, (-(best[i] + score + done), (*sizes, i - at), i, done + score,
                                        (ids, path)))

    def segment(self, part: str) -> tuple:
        """(score, loss of the second choice or None, ids as bytes, segment), by itself."""
        found = self.search(part)
        score, ids = next(found)
        second = next(found, None)
        return score, None if second is None else score - second[0], _packed(ids), part

    def prepare(self, texts: list[str]) -> list[np.ndarray]:
        """The places of the texts' segments in the cache; new ones are searched together."""
        cache = self.cache
        cache.shrink()
        cache.now += 1
        names = [self.parts(" " + t) if t else [] for t in texts]
        short, other = [], []
        for part in set().union(*names) - cache.index.keys():
            text = part.replace(" ", SPACE)
            if SPACE not in part and self.batches.fits(text):
                short.append((part, text))
            else:
                other.append(self.segment(part))
        short.sort(key=lambda x: len(x[1]))
        for a in range(0, len(short), TOGETHER):
            some = short[a:a + TOGETHER]
            cache.add([part for part, _ in some], *self.batches.two_best([t for _, t in some]))
        if other:
            scores, losses, ids, parts = zip(*other)
            cache.add(list(parts), scores, [Segments.ALONE if x is None else x for x in losses],
                      np.frombuffer(b"".join(ids), "<i4"), [len(x) // 4 for x in ids])
        return [cache.places(x) for x in names]

    def first(self, part: str, n: int) -> list:
        """The first ``n`` (loss, ids as bytes) of a segment."""
        kept = self.deeper.get((part, n))
        if kept is None:
            if len(self.deeper) >= CACHE // 8:
                self.deeper.clear()
            found = [x for _, x in zip(range(n), self.search(part))]
            kept = [(found[0][0] - s, _packed(ids)) for s, ids in found]
            self.deeper[part, n] = kept
        return kept

    def nbest(self, text: str, n: int, places: np.ndarray | None = None) -> list:
        """The ``n`` best (score, ids as little-endian int32 bytes) of a text, or as many as there are.

        ``places`` are those of its segments, where :meth:`prepare` has just given them.
        """
        return [(score, ids) for score, ids, _ in self.ranked(text, n, places)]

    def ranked(self, text: str, n: int, places: np.ndarray | None = None) -> list:
        """:meth:`nbest` with what each one changes of the best: (first id, how many, ids in their place)."""
        if not text:
            return [(0, b"", [])]
        cache = self.cache
        at = self.prepare([text])[0] if places is None else places
        score = int(cache.scores[at].sum())
        ids, ends = cache.gathered(at)
        best = ids.astype("<i4").tobytes()
        out = [(score, best, [])]
        if n == 1:
            return out
        losses = cache.losses[at]
        last = np.partition(losses, n - 2)[n - 2] if len(at) >= n else Segments.ALONE
        few = np.flatnonzero((losses <= last) & (losses < Segments.ALONE))
        # ties: the earlier segment
        few = few[np.argsort(losses[few], kind="stable")][:n - 1].tolist()
        open_ = [self.first(cache.names[at[k]], n) for k in few]
        spans = sorted((4 * int(ends[k] - cache.sizes[at[k]]), 4 * int(ends[k]), x) for x, k in enumerate(few))
        agenda = [(c[1][0], tuple(int(x == y) for y in range(len(open_))), x) for x, c in enumerate(open_)]
        heapq.heapify(agenda)
        while agenda and len(out) < n:
            loss, ranks, at_ = heapq.heappop(agenda)
            parts, done, edits = [], 0, []
            for begin, end, x in spans:
                if ranks[x]:
                    new = open_[x][ranks[x]][1]
                    parts += [best[done:begin], new]
                    edits.append((begin // 4, (end - begin) // 4, new))
                    done = end
            out.append((score - loss, b"".join([*parts, best[done:]]), edits))
            for x in range(at_, len(open_)):
                r = ranks[x] + 1
                choices = open_[x]
                if r < len(choices):
                    more = loss + choices[r][0] - choices[r - 1][0]
                    heapq.heappush(agenda, (more, (*ranks[:x], r, *ranks[x + 1:]), x))
        return out

    def decode(self, ids) -> str:
        """The text of piece ids: the first space was put in front when encoding."""
        joined = b"".join(map(self.bytes_of.__getitem__, ids))
        return joined[1:].decode("utf-8", "replace")


def _packed(ids) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)
