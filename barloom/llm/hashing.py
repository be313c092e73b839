"""Word and window hashes of whole texts in numpy."""

from __future__ import annotations

import numpy as np

STEP = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
BLOCK = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base % 2**64, np.uint64)]).cumprod(dtype=np.uint64)


PLACES = powers(STEP, 65)[1:]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values (finalizer of a multiply-shift hash)."""
    x = x + np.uint64(salt * STEP % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
VALUES = mix(np.arange(1, 257, dtype=np.uint64))
LOWER_VALUES = VALUES.copy()
LOWER_VALUES[65:91] = VALUES[97:123]
_POWERS: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(BLOCK, 1 << n.bit_length())
        _POWERS["up"], _POWERS["down"] = powers(STEP, size), powers(pow(STEP, -1, 2**64), size)
    return _POWERS["up"], _POWERS["down"]


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the words."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = IS_WORD[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit hash for every word: byte values times powers, summed once over the text and taken
    apart at the word bounds. Long texts go in blocks that end between words."""
    data, found, at = np.frombuffer(text, dtype=np.uint8), [], 0
    while at < len(data) or not found:
        cut = at + BLOCK
        while cut < len(data) and IS_WORD[data[cut]]:
            cut += 1
        found.append(_hash_block(data[at:cut], LOWER_VALUES if lower else VALUES))
        at = cut
    return np.concatenate(found)


def _hash_block(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    start, end = bounds(data)
    up, down = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        total += h[j : j + n] * PLACES[j]
    return mix(total)
