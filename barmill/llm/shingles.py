"""Sets of word shingles as sorted arrays of 64-bit hashes, computed array by array.

Different shingles, and different sets, are told apart by 64 bits: among n of them a collision is expected n * n / 2**65
times.
"""

from __future__ import annotations

import numpy as np

#: Blanks between words; only A to Z are lower-cased.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
FOLD = bytes(32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes hashed at a time; longer texts go piece by piece.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 14)
        _powers[:] = [
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))))
            for b in (BASE, pow(BASE, -1, 1 << 64))
        ]
    return _powers[0], _powers[1]


def _hashed(data: bytes) -> np.ndarray:
    """A hash of each word of folded bytes."""
    codes = np.frombuffer(data, np.uint8)
    word = np.concatenate(([False], codes != 32, [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(codes))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(BYTES[codes] * up[: len(codes)])))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(text: str) -> np.ndarray:
    data = text.encode("utf-8", "surrogatepass").translate(FOLD)
    if len(data) <= PIECE:
        return _hashed(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            end = cut if cut > at else (data.find(b" ", end) + 1 or len(data))
        out.append(_hashed(data[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Hashes of the distinct k-word shingles in ascending order; fewer words make one shingle, none make none."""
    found = words(text or "")
    n = len(found)
    if not n:
        return found
    size = min(n, k)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total = mixed(total * np.uint64(BASE) + found[j : n - size + 1 + j])
    return np.unique(total)


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    total = mixed(tokens + np.uint64(BASE)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mixed(np.array([total]))[0].astype(np.int64))
