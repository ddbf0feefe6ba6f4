"""Words and word windows of whole texts as numpy arrays, for use inside Arrow tasks.

A batch of texts is cut into slices of a few MB (one text is never cut); the arrays of a slice are the
only thing in memory. Words are runs of bytes that are not space, tab, LF, VT, FF or CR, and a text's
edges also end a word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(index of the first text, texts) of at most limit bytes, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


class Words:
    """The words of a slice of texts: `start` and `end` in `data`, and `first`, each text's first word."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.data = raw[bounds[0] : bounds[-1]] if len(bounds) else raw
        self.bounds = bounds - bounds[0]
        if lower:
            self.data = np.where((self.data >= 65) & (self.data <= 90), self.data + np.uint8(32), self.data)
        self.inside = (self.data != 32) & ((self.data < 9) | (self.data > 13))
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.bounds] = True
        gap = np.concatenate([[True], ~self.inside, [True]])
        self.start = np.flatnonzero(self.inside & (gap[:-2] | edge[:-1]))
        self.end = np.flatnonzero(self.inside & (gap[2:] | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.first)

    def per_text(self, flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """How many flags are set between each text's bounds."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(total[bounds])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, eight bytes at a time."""
        length = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(self.data) + 1, "<u8", buffer=padded, strides=(1,))
        out = mix(length.astype(np.uint64) * _K1 + _K3)
        todo, step = np.arange(len(length)), 0
        while len(todo):
            left = np.minimum(length[todo] - step, 8).astype(np.uint64)
            value = eights[self.start[todo] + step] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))
            out[todo] = mix((out[todo] ^ value) * _K1 + _K2)
            step += 8
            todo = todo[length[todo] > step]
        return out

    def owner(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the width words from each word on, and whether they all lie in the word's text."""
        n = len(hashes)
        out = np.zeros(n, np.uint64)
        if n >= width:
            part = np.zeros(n - width + 1, np.uint64)
            for j in range(width):
                part = part * _K1 + hashes[j : n - width + 1 + j]
            out[: n - width + 1] = mix(part)
        fits = np.arange(n) + width <= np.repeat(self.first[1:], self.counts)
        return out, fits


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with the same value in the first column, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[0].column(0)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for cut in cuts:
            yield pa.Table.from_batches([*held, batch.slice(at, cut - at)])
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


class Groups:
    """Union-find over 0 .. n-1; the root of a group is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
