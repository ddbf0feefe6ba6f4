"""Suffix trees of symbol sequences, common extensions in constant time, and all maximal periodic runs."""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """Ukkonen's tree of a sequence of symbols from 1 on, closed by a 0, and an Euler tour over it.

    place[i] is where the tour meets the leaf of suffix i; the least string depth between two places is the depth
    of the leaves' lowest common ancestor, which is their common prefix.
    """

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        self.n = len(symbols)
        self._build(text, max(text) + 1)
        self._tour()

    def _build(self, text: list[int], radix: int) -> None:
        n = len(text)
        start, stop, link, child_of = [0], [0], [0], {}
        node = edge = length = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            linkless = 0
            while waiting:
                if not length:
                    edge = i
                key = node * radix + text[edge]
                child = child_of.get(key)
                if child is None:
                    child_of[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    link[linkless] = node
                    linkless = node
                else:
                    begin = start[child]
                    width = min(stop[child], i + 1) - begin
                    if length >= width:
                        edge += width
                        length -= width
                        node = child
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        link[linkless] = node
                        break
                    split = child_of[key] = len(start)
                    start += (begin, i)
                    stop += (begin + length, n)
                    link += (0, 0)
                    child_of[split * radix + symbol] = split + 1
                    start[child] = begin + length
                    child_of[split * radix + text[begin + length]] = child
                    link[linkless] = split
                    linkless = split
                link[0] = 0
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
            link[0] = 0
        keys = np.fromiter(child_of.keys(), np.int64, len(child_of))
        order = np.argsort(keys)
        keys = keys[order]
        self.kids = np.fromiter(child_of.values(), np.int64, len(child_of))[order]
        self.by = keys % radix
        self.offsets = np.searchsorted(keys // radix, np.arange(len(start) + 1))
        self.width = np.array(stop) - np.array(start)

    def _tour(self) -> None:
        kids, width = self.kids.tolist(), self.width.tolist()
        at, last = self.offsets[:-1].tolist(), self.offsets[1:].tolist()
        depth, parent, place = [0] * len(width), [0] * len(width), [0] * (self.n + 1)
        tour, leaves, node = [0], [], 0
        while True:
            k = at[node]
            if k < last[node]:
                at[node] = k + 1
                child = kids[k]
                parent[child] = node
                depth[child] = deep = depth[node] + width[child]
                if at[child] == last[child]:
                    suffix = self.n + 1 - deep
                    place[suffix] = len(tour)
                    leaves.append(suffix)
                    tour += (deep, depth[node])
                    continue
                node = child
                tour.append(deep)
            elif node:
                node = parent[node]
                tour.append(depth[node])
            else:
                break
        self.tour, self.place = np.array(tour, np.int32), np.array(place)
        self.depth, self.leaves = depth, leaves

    def ranks(self, inverted: bool = False) -> np.ndarray:
        """The rank of every suffix; `inverted` turns the order of symbols, but an end still sorts first."""
        leaves = self.leaves
        if inverted:
            kids, offsets, by = self.kids.tolist(), self.offsets.tolist(), self.by.tolist()
            leaves, stack = [], [0]
            while stack:
                node = stack.pop()
                low, high = offsets[node], offsets[node + 1]
                if low == high:
                    leaves.append(self.n + 1 - self.depth[node])
                elif by[low]:
                    stack += kids[low:high]
                else:
                    stack += kids[low + 1 : high]
                    stack.append(kids[low])
        out = np.empty(self.n + 1, np.int64)
        out[leaves] = np.arange(self.n + 1)
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the common prefix of suffixes i and j (i != j): two lookups each in a table of range
        minima over the tour. All pairs are answered level by level, so one level is in memory at a time."""
        a, b = self.place[i], self.place[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out, table = np.zeros(len(low), np.int64), self.tour
        for k in range(int(level.max(initial=0)) + 1):
            now = np.flatnonzero(level == k)
            out[now] = np.minimum(table[low[now]], table[high[now] - (1 << k) + 1])
            table = np.minimum(table[: -(1 << k)], table[1 << k :]) if len(table) > 1 << k else table
        return out


def lyndon_ends(ranks: np.ndarray) -> np.ndarray:
    """The end of the longest Lyndon word from every place: the next smaller suffix."""
    rank, out, stack = ranks.tolist(), [0] * (len(ranks) - 1), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def maximal_runs(symbols: list[int], least: int = 2) -> np.ndarray:
    """All runs (start, length, period) of at least two periods and `least` symbols, sorted by start and period.

    Every run contains its root as the longest Lyndon word from some place, in the order of symbols or in the
    inverted one. So the two Lyndon words from each place are the candidates; each is extended to the right in the
    tree of the sequence and to the left in the tree of its reversal.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    ahead, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    where = np.arange(n)
    ends = [lyndon_ends(ahead.ranks(inverted)) for inverted in (False, True)]
    start, end = np.tile(where, 2), np.concatenate(ends)
    period = end - start
    right = ahead.common(start, end)
    left = back.common(n - start, n - end)
    found = (left + right >= period) & (left + right + period >= least)
    runs = np.stack([start - left, left + right + period, period], axis=1)[found]
    runs = np.unique(runs, axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]
