"""Vectorised 64-bit hashes of characters, words and shingles.

All arithmetic is modulo 2**64. A word's hash is the polynomial of its code
units, taken from one running sum per block by multiplying with the inverse
power of its start, so a whole block of words costs a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Odd multipliers, hence invertible modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
STEP = U(0xD6E8FEB86659FD93)
#: Code units hashed at once; a longer word makes its block as long as itself.
BLOCK = 1 << 18

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK)
        both = []
        for base in (BASE, BASE_INVERSE):
            steps = np.full(size, base, U)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if size > BLOCK:
            return both[0], both[1]
        _powers[:] = both
    return _powers[0], _powers[1]


def blocks(space: np.ndarray, block: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges that cover all code units, cut at white space only."""
    n, start = len(space), 0
    while start < n:
        end = start + block
        if end >= n:
            yield start, n
            return
        back = space[start:end][::-1].argmax()
        if space[end - 1 - back]:
            end -= int(back)
        else:
            ahead = space[end:].argmax()
            end = end + int(ahead) + 1 if space[end + int(ahead)] else n
        yield start, end
        start = end


def word_limits(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run that is not space."""
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def hash_words(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words codes[start:end]; equal words have equal hashes anywhere."""
    if not len(starts):
        return np.zeros(0, U)
    power, inverse = _tables(len(codes))
    total = np.zeros(len(codes) + 1, U)
    np.cumsum((codes.astype(U) + U(1)) * power[: len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U) * STEP)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive words; of the whole sequence if there are fewer."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    out = np.zeros(n - width + 1, U)
    for j in range(width):
        out *= STEP
        out += words[j: j + len(out)]
    return mix(out + U(width))
