"""A run-length index of short strings: their run-compressed Burrows-Wheeler transform with sampled run ends, and matching
statistics streamed against it.

Built and read with numpy for many strings at once, inside a task, over a bounded shard.
"""

from __future__ import annotations

import numpy as np

#: Symbols that the first round of sorting packs into one number, and strings up to which that has room for their numbers.
PACK, ROOM = 6, 1 << 15


def firsts(ordered: np.ndarray) -> np.ndarray:
    """For sorted keys the place of the first one that equals each."""
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def ranks(keys: np.ndarray) -> np.ndarray:
    """How many keys are less than each."""
    order = np.argsort(keys)
    out = np.empty(len(order), np.int64)
    out[order] = firsts(keys[order])
    return out


class RunIndex:
    """Strings, each closed by a separator of its own that is less than all bytes and equal to no other."""

    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) + 1 for s in strings], np.int64)
        n = int(size.sum())
        ends = np.cumsum(size) - 1
        x = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        x[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        self.text = x
        self.levels: list[tuple[int, np.ndarray]] = []
        self._sort(x, ends)
        self._compress(x)

    def _sort(self, x: np.ndarray, ends: np.ndarray) -> None:
        """Suffixes by prefix doubling. The ranks of each round stay, to compare substrings by."""
        n = len(x)
        line = np.searchsorted(ends, np.arange(n))  # which separator comes next
        left = ends[line] - np.arange(n)
        packed = np.zeros(n, np.uint64)
        for i in range(PACK):
            packed *= np.uint64(257)
            some = left >= i
            packed[some] += x[np.flatnonzero(some) + i].astype(np.uint64)
        # What reaches a separator is told apart by that one's number.
        number = np.where(left < PACK, line + 1, 0).astype(np.uint64)
        if len(ends) >= ROOM:
            packed = ranks(packed).astype(np.uint64) * np.uint64(len(ends) // ROOM + 1)
        rank = ranks(packed * np.uint64(ROOM) + number)
        width = PACK
        self.levels.append((width, rank.astype(np.int32)))
        # Suffixes that nothing equals have their final rank.
        twins = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        while len(twins):
            own, after = rank[twins], np.zeros(len(twins), np.int64)
            some = twins + width < n
            after[some] = rank[twins[some] + width]
            keys = own * n + after
            order = np.argsort(keys)
            keys, held = keys[order], twins[order]
            same = firsts(keys)
            rank[held] = own[order] + same - firsts(own[order])
            width *= 2
            self.levels.append((width, rank.astype(np.int32)))
            count = np.bincount(same, minlength=len(same))
            twins = held[count[same] > 1]
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[rank] = np.arange(n)

    def _compress(self, x: np.ndarray) -> None:
        before = x[self.suffixes - 1]
        new = np.ones(len(x), bool)
        new[1:] = before[1:] != before[:-1]
        self.start = np.flatnonzero(new)  # of runs
        self.end = np.r_[self.start[1:], len(x)] - 1
        self.symbol = before[self.start]
        by = np.argsort(self.symbol, kind="stable")
        length = (self.end - self.start + 1)[by]
        self.first = np.empty(len(by), np.int64)  # where a run's symbols stand in sorted order
        self.first[by] = np.cumsum(length) - length
        self.by, self.keys = by, self.symbol[by] * (len(by) + 1) + by
        self.at_start, self.at_end = self.suffixes[self.start], self.suffixes[self.end]  # the samples
        del self.suffixes

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes at different places."""
        got = np.zeros(len(a), np.int64)
        last = len(self.text) - 1
        for width, rank in reversed(self.levels):
            got += np.where(rank[np.minimum(a + got, last)] == rank[np.minimum(b + got, last)], width, 0)
        for _ in range(PACK - 1):
            p, q = self.text[np.minimum(a + got, last)], self.text[np.minimum(b + got, last)]
            got += (p == q) & (p > 0)
        return got

    def matching(self, strings: list[bytes]) -> list[np.ndarray]:
        """For each string and place the length of the longest prefix from there on that stands in the index.

        Strings are read from their ends. While the symbol stands before the present suffix, its run tells the next one; if not,
        the nearest ends of runs of that symbol, up and down, are the candidates, and the one with more in common goes on.
        """
        order = np.argsort([-len(s) for s in strings], kind="stable")
        size = np.array([len(strings[i]) for i in order], np.int64)
        first = np.cumsum(size) - size
        x = np.frombuffer(b"".join(strings[i] for i in order), np.uint8).astype(np.int64) + 1
        out = np.zeros(len(x), np.int64)
        row, place, length = (np.zeros(len(size), np.int64) for _ in range(3))
        place += self.at_start[0]
        runs = len(self.start)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step, "left"))  # strings longer than step come first
            at = first[:live] + size[:live] - 1 - step
            c, q, p, n = x[at], row[:live], place[:live], length[:live]
            run = np.searchsorted(self.start, q, "right") - 1
            odd = np.flatnonzero(self.symbol[run] != c)
            if len(odd):
                k = np.searchsorted(self.keys, c[odd] * (runs + 1) + run[odd])
                best, new = np.full(len(odd), -1, np.int64), p[odd]
                for j, rows, samples in ((k - 1, self.end, self.at_end), (k, self.start, self.at_start)):
                    near = self.by[np.clip(j, 0, runs - 1)]
                    ok = np.flatnonzero((j >= 0) & (j < runs) & (self.symbol[near] == c[odd]))
                    r = near[ok]
                    same = np.minimum(n[odd[ok]], self.common(p[odd[ok]], samples[r]))
                    up = same > best[ok]
                    ok, r = ok[up], r[up]
                    best[ok], new[ok] = same[up], samples[r]
                    run[odd[ok]], q[odd[ok]] = r, rows[r]
                p[odd], n[odd] = new, best
            none = n < 0
            q[:] = np.where(none, 0, self.first[run] + q - self.start[run])
            p[:] = np.where(none, self.at_start[0], p - 1)
            n += 1
            out[at] = n
        back: list = [None] * len(strings)
        for k, i in enumerate(order):
            back[i] = out[first[k] : first[k] + size[k]]
        return back
