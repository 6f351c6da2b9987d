"""Exact cosine neighbours from an inverted index with block maxima.

Examples are numbered so that similar ones are near each other, and cut into blocks. A term
of few examples has a list of postings; one of many has a row of weights over all examples,
and the largest weight in each block. A query adds up its postings. With the block maxima of
its frequent terms that bounds each example's similarity. Examples whose bound is not under
the k-th similarity found so far are compared in full; where these are many, the frequent
terms of all such queries are first multiplied with their rows at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

BLOCK = 64
FREQUENT = 16  # a term in one of so many examples has a row
_ALONE = 64  # examples that are compared in full without looking at rows
_AT_ONCE = 192  # queries whose rows are multiplied together: rows are read once for all of them
_ROUNDED = 1e-5  # far more than single precision loses in a similarity

Vector = tuple[np.ndarray, np.ndarray]


def spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each span of ``size``, one span after the other."""
    ends = np.cumsum(size, dtype=np.int64)
    return np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class BlockMaxIndex:
    """Vectors are (term numbers in order, weights) of length 1; ``terms`` is the size of the vocabulary."""

    def __init__(self, vectors: Sequence[Vector], terms: int):
        leading = [int(t[np.argmax(w)]) if len(t) else terms for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (leading[i], i)), np.int64)
        self.place = np.argsort(self.order)
        self.count, self.terms = len(vectors), terms
        sizes = np.array([len(vectors[i][0]) for i in self.order], np.int64)
        self.own = np.concatenate([[0], np.cumsum(sizes)])  # where each example's own terms begin
        self.own_terms = np.concatenate([vectors[i][0].astype(np.int32) for i in self.order] or [np.zeros(0, np.int32)])
        self.own_weights = np.concatenate([vectors[i][1] for i in self.order] or [np.zeros(0)])
        example = np.repeat(np.arange(self.count, dtype=np.int32), sizes)
        lengths = np.bincount(self.own_terms, minlength=terms)
        frequent = np.flatnonzero(lengths * FREQUENT > max(self.count, BLOCK))
        self.row = np.full(terms, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        row = self.row[self.own_terms]
        blocks = -(-max(1, self.count) // BLOCK)
        self.rows = np.zeros((len(frequent), blocks * BLOCK), np.float32)
        self.rows[row[row >= 0], example[row >= 0]] = self.own_weights[row >= 0]
        self.maxima = np.nextafter(self.rows.reshape(len(frequent), blocks, BLOCK).max(axis=2), np.float32(np.inf))
        rare = np.flatnonzero(row < 0)
        rare = rare[np.argsort(self.own_terms[rare], kind="stable")]
        self.example, self.weight = example[rare], self.own_weights[rare].astype(np.float32)
        self.postings = np.searchsorted(self.own_terms[rare], np.arange(terms + 1)).astype(np.int32)
        self._query = np.zeros(terms)  # the weights of the query at work
        self.compared = self.multiplied = 0

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> Vector:
        return self.nearest_many([(terms, weights)], k, [without])[0]

    def nearest_many(self, queries: Sequence[Vector], k: int, without: Sequence[int] | None = None) -> list[Vector]:
        """Numbers and similarities of each query's k most similar examples that share a term, ties by number."""
        out: list[Vector] = []
        for first in range(0, len(queries), _AT_ONCE):
            some = queries[first : first + _AT_ONCE]
            out += self._together(some, k, [-1] * len(some) if without is None else without[first : first + _AT_ONCE])
        return out

    def _together(self, queries: Sequence[Vector], k: int, without: Sequence[int]) -> list[Vector]:
        out: list[Vector] = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        if not self.count:
            return out
        frequent = np.zeros((len(queries), len(self.rows)), np.float32)
        for weights, (terms, own) in zip(frequent, queries):
            row = self.row[terms]
            weights[row[row >= 0]] = own[row >= 0]
        bounds = frequent @ self.maxima + _ROUNDED
        open_: list[tuple[int, np.ndarray, float]] = []
        for i, (terms, weights) in enumerate(queries):
            if not len(terms):
                continue
            sums = self._rare(terms, weights)
            least = self._least(sums, k, without[i])
            reach = (sums.reshape(-1, BLOCK) + bounds[i][:, None]).reshape(-1)[: self.count]
            near = np.flatnonzero(reach >= least)
            if len(near) <= _ALONE:
                out[i] = self._best(queries[i], near, k, without[i])
            else:
                open_.append((i, sums, least))
        if open_:
            self.multiplied += len(open_)
            more = frequent[[i for i, _, _ in open_]] @ self.rows
            for (i, sums, least), add in zip(open_, more):
                sums = (sums + add)[: self.count]
                sums[self.place[without[i]] if without[i] >= 0 else []] = -1
                if self.count > k:
                    least = max(least, float(np.partition(sums, -k)[-k]) - 2 * _ROUNDED)
                near = np.flatnonzero((sums >= least) & (sums > 0))
                out[i] = self._best(queries[i], near, k, without[i])
        return out

    def _rare(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What rare terms add to each example's similarity, in whole blocks."""
        begin = self.postings[terms]
        size = self.postings[terms + 1] - begin
        at = spans(begin, size)
        each = self.weight[at] * np.repeat(weights, size)
        return np.bincount(self.example[at], each, minlength=self.rows.shape[1])

    def _least(self, sums: np.ndarray, k: int, without: int) -> float:
        """A similarity that k examples reach: the k-th largest by rare terms alone, to which others only add."""
        some = sums[: self.count]
        if without >= 0:
            some = np.delete(some, self.place[without])
        return max(0.0, float(np.partition(some, -k)[-k]) - _ROUNDED) if len(some) >= k else 0.0

    def _compare(self, query: Vector, places: np.ndarray) -> np.ndarray:
        """Similarities in full."""
        self.compared += len(places)
        self._query[query[0]] = query[1]
        sizes = self.own[places + 1] - self.own[places]
        starts = np.cumsum(sizes) - sizes
        at = spans(self.own[places], sizes)
        each = np.append(self._query[self.own_terms[at]] * self.own_weights[at], 0.0)
        self._query[query[0]] = 0.0
        return np.where(sizes > 0, np.add.reduceat(each, starts), 0.0)

    def _best(self, query: Vector, places: np.ndarray, k: int, without: int) -> Vector:
        likeness = self._compare(query, places) if len(places) else np.zeros(0)
        numbers = self.order[places]
        kept = (likeness > 0) & (numbers != without)
        numbers, likeness = numbers[kept], likeness[kept]
        best = np.lexsort((numbers, -np.round(likeness, 12)))[:k]
        return numbers[best], np.minimum(likeness[best], 1.0)
