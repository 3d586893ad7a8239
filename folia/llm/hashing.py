"""64-bit hashes of words and word sequences, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

from folia.llm.common import SPACE_BYTES

#: Odd 64-bit multipliers and a seed for the byte table.
BASE, STEP, SEED = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 20240607

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[list(SPACE_BYTES)] = True
_VALUES = np.random.default_rng(SEED).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    """base to the power 0 .. n-1 modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 24:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, A-Z lowered, and each word's text number. A word's hash is a polynomial in its bytes, from differences of one running sum."""
    begin, end = int(offsets[0]), int(offsets[-1])
    part = _LOWER[data[begin:end]]
    n = len(part)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = _BLANK[part]
    new_text = np.zeros(n + 1, bool)
    new_text[offsets - begin] = True
    first = ~blank & (np.concatenate([[True], blank[:-1]]) | new_text[:-1])
    last = ~blank & (np.concatenate([blank[1:], [True]]) | new_text[1:])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[part] * _power(BASE, n), dtype=np.uint64, out=sums[1:])
    inverse = pow(BASE, -1, 1 << 64)
    hashed = mix((sums[ends] - sums[starts]) * _power(inverse, n)[starts] + (ends - starts).astype(np.uint64))
    return hashed, np.searchsorted(offsets - begin, starts, "right") - 1


def sequences(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each `size` words in a row."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(STEP) + words[k : k + n])
    return out
