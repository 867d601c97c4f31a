"""Sets of hashed word shingles, computed with numpy for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .base import LOWER, UPPER

BLOCK = 1 << 20
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * BLOCK), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and where each text's begin (and the last one's end). A word is a run
    of bytes other than ASCII white space, A-Z lower-cased; its hash is a polynomial in 64 bits, whatever its place."""
    joined = b"\n".join(texts) + b"\n"
    x = np.frombuffer(joined.translate(FOLD), np.uint8)
    space = SPACE[x]
    edge = np.diff(np.r_[True, space].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(x)), out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * powers(INVERSE, len(x))[starts])
    first = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    return h, np.searchsorted(starts, first)


def sets(texts: list[bytes | None], k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes (63 bits): of k words each, or of all words where there are fewer."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (size < BLOCK or not some):
            some.append(texts[at] or b"")
            size += len(some[-1])
            at += 1
        h, first = word_hashes(some)
        n = len(h)
        sh = np.zeros(max(0, n - k + 1), np.uint64)
        for i in range(k):
            sh = sh * np.uint64(0xD6E8FEB86659FD93) + h[i : n - k + 1 + i]
        sh = mix(sh) >> np.uint64(1)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                yield np.unique(sh[a : b - k + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for v in h[a:b]:
                    whole = mix(np.array([whole]) * np.uint64(0xA24BAED4963EE407) + v)[0]
                yield np.array([whole >> np.uint64(1)])
            else:
                yield np.zeros(0, np.uint64)
