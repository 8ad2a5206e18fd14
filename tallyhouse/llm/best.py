"""The k best candidates of many queries at once, inside a task."""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).min


class Best:
    """For each of `n` queries its `k` highest scores, ties to the smaller id, NULL ids last.

    `kth` is what a candidate has to reach: the k-th score so far, or a higher `floor` that is known from elsewhere.
    """

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.score = np.full((n, k), NONE, np.int64)
        self.id = np.zeros((n, k), np.int64)
        self.known = np.zeros((n, k), bool)
        self.kth = np.full(n, NONE, np.int64) if floor is None else floor.astype(np.int64)

    def offer(self, query: np.ndarray, score: np.ndarray, id: np.ndarray, known: np.ndarray) -> bool:
        """Take up candidates, given as flat arrays; says if any was good enough."""
        fit = score >= self.kth[query]
        if not fit.any():
            return False
        query, score, id, known = query[fit], score[fit], id[fit], known[fit]
        touched = np.unique(query)
        row, col = np.nonzero(self.score[touched] != NONE)
        old = touched[row]
        query = np.concatenate((old, query))
        score = np.concatenate((self.score[old, col], score))
        id, known = np.concatenate((self.id[old, col], id)), np.concatenate((self.known[old, col], known))
        order = np.lexsort((id, ~known, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        order, query, place = order[kept], query[kept], place[kept]
        self.score[query, place], self.id[query, place], self.known[query, place] = score[order], id[order], known[order]
        self.kth[touched] = np.maximum(self.kth[touched], self.score[touched, -1])
        return True

    def held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Queries, scores, ids and which ids are known, of all that is held."""
        query, place = np.nonzero(self.score != NONE)
        return query, self.score[query, place], self.id[query, place], self.known[query, place]
