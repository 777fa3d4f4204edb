"""Run-length index of a text collection: run-compressed BWT with sampled run ends, and its matching statistics."""

from __future__ import annotations

import numpy as np

BASE = 7        # symbols packed in the first sort key: 9 bits each


class RunLengthIndex:
    """Suffixes of ``parts`` (byte strings, joined by a separator), kept as the runs of their BWT.

    Suffixes are sorted by prefix doubling up to ``depth`` symbols (at least the
    longest part and its separator, so the order is that of the whole parts).
    Per run only its symbol, its length and the text positions of its first and
    last suffix are kept, together with the common prefix lengths across the run's
    borders. Inside a run these follow from the preceding text position (the
    length drops by one per step), so the samples determine the matching statistics.
    """

    def __init__(self, parts: list[bytes]):
        sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        n = int(self.starts[-1])
        self.text = np.zeros(n, np.int16)           # 0: separator, byte + 1
        joined = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16) + 1
        inside = np.ones(n, bool)
        inside[self.starts[1:] - 1] = False
        self.text[inside] = joined
        self.n = n
        self._sort(int(sizes.max(initial=0)) + 1)
        self._runs()

    def _sort(self, depth: int) -> None:
        n, padded = self.n, np.concatenate([self.text, np.zeros(BASE, np.int16)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for k in range(BASE):
            key = (key << np.uint64(9)) | padded[k : k + n]
        self.levels: list[tuple[int, np.ndarray]] = []      # (symbols compared, rank of every position)
        width = BASE
        while True:
            order = np.argsort(key)
            sorted_key = key[order]
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
            self.levels.append((width, rank))
            if width >= depth or (n and rank[order[-1]] == n - 1):
                break
            shifted = np.zeros(n, np.int64)
            shifted[: max(0, n - width)] = rank[width:].astype(np.int64) + 1
            key = (rank.astype(np.uint64) << np.uint64(32)) | shifted.astype(np.uint64)
            width *= 2
        self.sa = order

    def _common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Common prefix lengths of suffix pairs, from the ranks of each doubling step."""
        size, n = np.zeros(len(p), np.int64), self.n
        for width, rank in reversed(self.levels):
            while True:
                a, b = p + size, q + size
                ok = (a < n) & (b < n) & (a != b)
                same = np.zeros(len(p), bool)
                same[ok] = rank[a[ok]] == rank[b[ok]]
                same &= (a + width <= n) & (b + width <= n)
                if not same.any():
                    break
                size[same] += width
                if width != self.levels[-1][0]:
                    break
        for _ in range(BASE):
            a, b = p + size, q + size
            ok = (a < n) & (b < n)
            ok[ok] = self.text[a[ok]] == self.text[b[ok]]
            size[ok] += 1
        return size

    def _runs(self) -> None:
        sa = self.sa
        bwt = self.text[sa - 1] if self.n else self.text
        change = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        # the suffix at text position 0 has the cyclic predecessor: its row always borders a run
        first = int(np.flatnonzero(sa == 0)[0]) if self.n else 0
        heads = np.unique(np.concatenate([[0], change, [first, first + 1]]))
        heads = heads[heads < self.n]
        ends = np.concatenate([heads[1:], [self.n]]) - 1
        self.run_symbol, self.run_length = bwt[heads], ends - heads + 1
        self.head_at, self.end_at = sa[heads], sa[ends]
        # common prefix of a run's first suffix with the one before it, of its last with the one after it
        above, below = heads > 0, ends < self.n - 1
        self.head_common = np.zeros(len(heads), np.int64)
        self.head_common[above] = self._common(sa[heads[above]], sa[heads[above] - 1])
        self.end_common = np.zeros(len(heads), np.int64)
        self.end_common[below] = self._common(sa[ends[below]], sa[ends[below] + 1])
        del self.sa, self.levels

    def matching_statistics(self) -> np.ndarray:
        """For every text position the length of the longest match that starts elsewhere in the collection.

        Streams over the text: a sampled position brings its own length, any other
        one less than the position before it.
        """
        at = np.arange(self.n)
        best = np.zeros(self.n, np.int64)
        for where, common in ((self.head_at, self.head_common), (self.end_at, self.end_common)):
            reach = np.full(self.n, -1, np.int64)
            reach[where] = where + common
            # a sample replaces what came before it, even with a smaller reach
            last = np.maximum.accumulate(np.where(reach >= 0, at, -1))
            value = np.where(last >= 0, reach[np.maximum(last, 0)] - at, 0)
            best = np.maximum(best, value)
        return np.maximum(best, 0)

    def part_statistics(self, k: int, stats: np.ndarray) -> np.ndarray:
        """The statistics of part ``k``, cut at its end."""
        lo, hi = int(self.starts[k]), int(self.starts[k + 1]) - 1
        return np.minimum(stats[lo:hi], np.arange(hi - lo, 0, -1))
