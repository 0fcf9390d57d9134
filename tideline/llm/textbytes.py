"""Words and byte strings of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

from tideline.llm.arrays import mix

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for i, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


#: A number for each byte; capitals A-Z count as small letters.
_VALUES = mix(np.arange(256, dtype=np.uint64))
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and per text how many words it has."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    start, end = edge[::2], edge[1::2]
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLDED[data] * up[:-1], out=prefix[1:])
    hashes = mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))
    counts = np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))
    return hashes, counts


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, sorted; fewer words than ``size`` are one shingle."""
    words, counts = word_hashes(texts)
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled = rolled * np.uint64(_ODD) + words[i : i + n]
    rolled = mix(rolled)
    out, at = [], 0
    for count in counts.tolist():
        if count >= size:
            out.append(np.unique(rolled[at : at + count - size + 1]))
        elif count:
            whole = np.uint64(count)
            for w in words[at : at + count]:
                whole = mix(np.array([whole]))[0] ^ w
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out
