"""Dual-tree search for the best scoring documents of many items, in numpy.

Items and documents are vectors over terms; a score is their inner product, a sum
of whole numbers.  Both sides stand in hierarchies whose nodes hold the maximum of
every coordinate.  The product of two nodes' maxima bounds the score of every item
below one with every document below the other, so where it does not reach the
weakest k-th score of those items, the whole batch of pairs is left out.  What is
left at the leaves is scored in full.  Bounds and scores are whole numbers that
floats hold exactly; where they might not be, 64-bit integers take their place.
"""

from __future__ import annotations

import numpy as np

#: Items below a leaf, leaves below a group, groups below a root.
LEAF_ITEMS, FAN = 8, 8
#: Documents below a leaf; documents of a chunk; terms of the items below a root.
LEAF_DOCS, CHUNK, TERMS = 16, 1024, 4096
NO_ID = np.int64(2**63 - 1)
EXACT = 2**53


def _grouped_max(rows: np.ndarray, size: int) -> np.ndarray:
    return np.maximum.reduceat(rows, np.arange(0, len(rows), size), axis=0)


class ItemRoot:
    """Up to ``LEAF_ITEMS * FAN**2`` items with their own list of terms."""

    def __init__(self, items: np.ndarray, vectors: list, kind):
        self.items = items
        self.terms = np.unique(np.concatenate([vectors[i][0] for i in items]))
        self.leaves, maxima = [], []
        for low in range(0, len(items), LEAF_ITEMS):
            own = items[low:low + LEAF_ITEMS]
            columns = np.unique(np.concatenate([vectors[i][0] for i in own]))
            rows = np.zeros((len(own), len(columns)), kind)
            for r, i in enumerate(own):
                rows[r, np.searchsorted(columns, vectors[i][0])] = vectors[i][1]
            at = np.searchsorted(self.terms, columns)
            self.leaves.append((slice(low, low + len(own)), at, rows))
            top = np.zeros(len(self.terms), kind)
            top[at] = rows.max(axis=0)
            maxima.append(top)
        self.leaf_max = np.array(maxima)
        self.group_max = _grouped_max(self.leaf_max, FAN)
        self.root_max = self.group_max.max(axis=0)


class ItemTrees:
    """All items of a block.  ``vectors`` holds (term ids ascending, weights) per item, none empty."""

    def __init__(self, vectors: list, best_impact: int):
        highest = max((int(w.sum()) for _, w in vectors), default=0) * best_impact
        self.kind = np.float64 if highest < EXACT else np.int64
        # items with the same heaviest terms stand together
        keys = []
        for i, (terms, weights) in enumerate(vectors):
            heavy = terms[np.lexsort([terms, -weights])[:2]]
            keys.append((*heavy.tolist(), i))
        self.roots, taken, terms = [], [], set()
        for key in sorted(keys):
            own = set(vectors[key[-1]][0].tolist())
            if taken and (len(taken) == LEAF_ITEMS * FAN * FAN or len(terms | own) > TERMS):
                self.roots.append(ItemRoot(np.array(taken), vectors, self.kind))
                taken, terms = [], set()
            taken.append(key[-1])
            terms |= own
        if taken:
            self.roots.append(ItemRoot(np.array(taken), vectors, self.kind))


class DocumentTree:
    """Some documents over the terms of an item root: leaves, groups, root.

    Document p of the order stands in column (p mod LEAF_DOCS) * leaves + p div
    LEAF_DOCS, so the maxima of all leaves are those of whole blocks of columns.
    """

    def __init__(self, root: ItemRoot, rows, columns, impacts, ids, kind):
        whose, row = np.unique(rows, return_inverse=True)
        # documents whose best term is the same stand together
        worth = impacts * root.root_max[columns].astype(np.float64)
        first = np.lexsort([columns, -worth, row])
        heads = np.flatnonzero(np.diff(row[first], prepend=-1))
        order = np.argsort(columns[first[heads]], kind="stable")
        n = len(whose)
        self.n_leaves = -(-n // (LEAF_DOCS * FAN)) * FAN
        place = np.empty(n, np.int64)
        p = np.arange(n)
        place[order] = p % LEAF_DOCS * self.n_leaves + p // LEAF_DOCS
        self.cells = np.zeros((len(root.terms), LEAF_DOCS * self.n_leaves), kind)
        self.cells[columns, place[row]] = impacts
        self.ids = np.full(LEAF_DOCS * self.n_leaves, NO_ID)
        self.ids[place] = ids[whose]
        blocks = self.cells.reshape(len(root.terms), LEAF_DOCS, self.n_leaves)
        self.leaf_max = blocks.max(axis=1)
        self.group_max = self.leaf_max.reshape(len(root.terms), -1, FAN).max(axis=2)
        self.root_max = self.group_max.max(axis=1)

    def columns_of(self, leaves: np.ndarray) -> np.ndarray:
        return (np.arange(LEAF_DOCS)[:, None] * self.n_leaves + leaves[None, :]).reshape(-1)


class Best:
    """The k best documents found so far for each item; equal scores by ascending id.

    ``floor`` (score, id) pairs are known to be reached by k documents: only what is
    as good counts at all.
    """

    def __init__(self, n: int, k: int, floor=None):
        self.k = k
        self.scores = np.zeros((n, k), np.int64)
        self.ids = np.full((n, k), NO_ID)
        self.weakest = np.zeros(n, np.int64)
        self.weakest_id = np.full(n, NO_ID)
        if floor is not None:
            known = floor[0] > 0
            self.weakest[known] = floor[0][known]
            # the document at the floor itself still counts
            self.weakest_id[known] = np.minimum(floor[1][known], NO_ID - 1) + 1

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        weak, weak_id = self.weakest[item], self.weakest_id[item]
        good = (scores > 0) & ((scores > weak) | ((scores == weak) & (ids < weak_id)))
        if not good.any():
            return
        scores = np.concatenate([self.scores[item], scores[good].astype(np.int64)])
        ids = np.concatenate([self.ids[item], ids[good]])
        first = np.lexsort([ids, -scores])[:self.k]
        self.scores[item], self.ids[item] = scores[first], ids[first]
        if self.scores[item, -1] > 0:
            self.weakest[item], self.weakest_id[item] = self.scores[item, -1], self.ids[item, -1]


def _search_root(root: ItemRoot, docs: DocumentTree, best: Best) -> int:
    """Offer every pair that no bound leaves out; returns how many pairs were scored."""
    weakest = best.weakest[root.items]
    if root.root_max @ docs.root_max < max(1, weakest.min()):
        return 0
    starts = np.arange(0, len(root.items), LEAF_ITEMS)
    leaf_weak = np.maximum(np.minimum.reduceat(weakest, starts), 1)
    group_weak = _grouped_max(-leaf_weak, FAN) * -1
    groups = root.group_max @ docs.group_max >= group_weak[:, None]
    scored = 0
    for g in np.flatnonzero(groups.any(axis=1)):
        below = (np.flatnonzero(groups[g])[:, None] * FAN + np.arange(FAN)).reshape(-1)
        low = g * FAN
        bounds = root.leaf_max[low:low + FAN] @ docs.leaf_max[:, below]
        open_ = bounds >= leaf_weak[low:low + FAN, None]
        for leaf in np.flatnonzero(open_.any(axis=1)):
            own, at, rows = root.leaves[low + leaf]
            places = docs.columns_of(below[open_[leaf]])
            scores = rows @ docs.cells[at][:, places]
            ids = docs.ids[places]
            scored += scores.size
            items = root.items[own]
            hit = (scores >= np.maximum(best.weakest[items], 1)[:, None]).any(axis=1)
            for r in np.flatnonzero(hit):
                best.offer(items[r], scores[r], ids)
    return scored


def search_chunk(trees: ItemTrees, best: Best, rows, terms, impacts, ids) -> int:
    """Search documents given by cells (row, term, impact) and the id of each row."""
    scored = 0
    for root in trees.roots:
        at = np.minimum(np.searchsorted(root.terms, terms), len(root.terms) - 1)
        own = root.terms[at] == terms
        if own.any():
            docs = DocumentTree(root, rows[own], at[own], impacts[own], ids, trees.kind)
            scored += _search_root(root, docs, best)
    return scored
