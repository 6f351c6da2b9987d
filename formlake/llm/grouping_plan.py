"""Packing lengths into bins by linear grouping, from a histogram alone.

Large lengths are rounded up to the largest of their group, the groups holding equally
many pieces; a linear programme over bin configurations of these few sizes is solved by
column generation and rounded down. The actual lengths then take the places of the
rounded ones, and everything left is put where it fits best. Pieces of one length are
handled as runs, so the work depends on the capacity and not on the number of pieces.

Pieces are numbered by falling length. A segment puts the pieces ``first`` to ``last`` of
one length into consecutive bins, one each, at the same offset.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np

GROUPS = 64


def _best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the configuration of highest value."""
    best = np.zeros(capacity + 1)
    for size, value in zip(sizes, values):
        if value > 1e-12:
            for times in range(capacity // size):  # each round allows one more of this size
                moved = np.concatenate([np.full(size, -1.0), best[:-size] + value])
                better = moved > best + 1e-12
                if not better.any():
                    break
                best = np.where(better, moved, best)
    counts, left, top = np.zeros(len(sizes)), capacity, best[capacity]
    while True:  # walk back through the table
        for i, (size, value) in enumerate(zip(sizes, values)):
            if value > 1e-12 and size <= left and abs(best[left] - value - best[left - size]) < 1e-9:
                counts[i] += 1
                left -= size
                break
        else:
            return top, counts


def solve_configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[int, list[int]]]:
    """(bins, count of each size) from the LP over configurations, rounded down."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        top, column = _best_configuration(sizes, prices, capacity)
        if top <= 1 + 1e-7:
            break
        amounts, step = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        positive = step > 1e-9
        if not positive.any():
            break
        ratios = np.where(positive, np.maximum(amounts, 0) / np.where(positive, step, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    amounts = np.linalg.solve(basis, need)
    left = list(demand)
    chosen = []
    for j in np.argsort(-amounts):
        counts = [int(c) for c in np.rint(basis[:, j])]
        bins = min([int(amounts[j] + 1e-6), *(left[i] // c for i, c in enumerate(counts) if c)])
        if bins > 0 and any(counts):
            chosen.append((bins, counts))
            left = [n - bins * c for n, c in zip(left, counts)]
    return chosen


class Plan:
    """Segments (first, last, bin of the first, offset) for the pieces of a histogram."""

    def __init__(self, histogram: dict[int, int], capacity: int, groups: int, small: float):
        self.capacity, self.small, self.bins = capacity, small * capacity, 0
        self.segments: list[tuple[int, int, int, int]] = []
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first bin, bins)
        self.rooms: list[int] = []
        self.runs: list[list[int]] = []  # length, first piece, last piece
        at = 0
        for length in sorted(histogram, reverse=True):
            if histogram[length]:
                self.runs.append([length, at, at + histogram[length]])
                at += histogram[length]
        self._place_large(groups)
        for run in self.runs:
            self._best_fit(*run)

    def _add_room(self, room: int, first_bin: int, bins: int) -> None:
        if room and bins:
            if not self.free[room]:
                insort(self.rooms, room)
            self.free[room].append((first_bin, bins))

    def _open(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def _place_large(self, groups: int) -> None:
        large = [run for run in self.runs if self.small < run[0] < self.capacity]
        if not large:
            return
        first, last = large[0][1], large[-1][2]
        share = -(-(last - first) // groups)
        cuts = [*range(first, last, share), last]
        starts = [run[1] for run in large]

        def length_at(piece: int) -> int:
            return large[bisect_left(starts, piece + 1) - 1][0]

        sizes, demand, spans = [], [], []
        for a, b in zip(cuts, cuts[1:]):  # groups of one rounded size are one
            size = length_at(a)
            if sizes and sizes[-1] == size:
                demand[-1] += b - a
                spans[-1][1] = b
            else:
                sizes.append(size)
                demand.append(b - a)
                spans.append([a, b])
        for bins, counts in solve_configurations(sizes, demand, self.capacity):
            slots = []
            for i, count in enumerate(counts):
                for _ in range(count):
                    slots.append(spans[i][0])
                    spans[i][0] += bins
            self._fill(bins, slots, large, starts)
        left = []
        for a, b in spans:  # what rounding down has left over
            while a < b:
                run = large[bisect_left(starts, a + 1) - 1]
                end = min(b, run[2])
                left.append([run[0], a, end])
                a = end
        self.runs = [run for run in self.runs if run not in large] + left
        self.runs.sort(key=lambda run: run[1])

    def _fill(self, bins: int, slots: list[int], large: list[list[int]], starts: list[int]) -> None:
        """Put the pieces from each slot's first one on into ``bins`` new bins."""
        first_bin = self._open(bins)
        breaks = {0, bins}
        for piece in slots:
            at = bisect_left(starts, piece + 1) - 1
            while at < len(large) and large[at][1] < piece + bins:
                breaks.add(min(bins, max(0, large[at][1] - piece)))
                at += 1
        edges = sorted(breaks)
        for a, b in zip(edges, edges[1:]):
            offset = 0
            for piece in slots:
                self.segments.append((piece + a, piece + b, first_bin + a, offset))
                offset += large[bisect_left(starts, piece + a + 1) - 1][0]
            self._add_room(self.capacity - offset, first_bin + a, b - a)

    def _stack(self, length: int, first: int, count: int, room: int, first_bin: int, bins: int) -> int:
        """Put ``count`` pieces into bins of equal room, each filled before the next; the bins used."""
        times = room // length
        full, rest = min(bins, count // times), 0
        if full < bins:
            rest = count - full * times
        offset = self.capacity - room
        for layer in range(times):
            if full:
                self.segments.append((first + layer * full, first + (layer + 1) * full, first_bin, offset + layer * length))
        for layer in range(rest):
            piece = first + full * times + layer
            self.segments.append((piece, piece + 1, first_bin + full, offset + layer * length))
        self._add_room(room - times * length, first_bin, full)
        if rest:
            self._add_room(room - rest * length, first_bin + full, 1)
        return full + bool(rest)

    def _best_fit(self, length: int, first: int, last: int) -> None:
        while first < last:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                bins = -(-(last - first) // (self.capacity // length))
                self._stack(length, first, last - first, self.capacity, self._open(bins), bins)
                return
            room = self.rooms[at]
            first_bin, bins = self.free[room].pop()
            if not self.free[room]:
                self.rooms.pop(at)
            put = min(last - first, bins * (room // length))
            used = self._stack(length, first, put, room, first_bin, bins)
            self._add_room(room, first_bin + used, bins - used)
            first += put


def best_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """The plan of fewest bins among several bounds between large and small."""
    return min((Plan(histogram, capacity, GROUPS, small) for small in (0.25, 1 / 3, 0.5)), key=lambda plan: plan.bins)
