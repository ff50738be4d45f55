"""Word shingles of whole batches of texts, hashed with array operations only."""

from __future__ import annotations

import numpy as np

WORDS = 5

_RANDOM = np.random.default_rng(20240531)
#: A random value for each byte; upper-case ASCII letters share that of the lower-case ones.
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
#: ASCII white space separates words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = int(_RANDOM.integers(1, 1 << 63, dtype=np.uint64)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Multipliers of a shingle's words by position, and of whole short texts by their number of words.
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

_powers = np.ones(1, dtype=np.uint64)
_backs = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    global _powers, _backs
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        tables = []
        for factor in (_BASE, _INVERSE):
            factors = np.full(size, factor, dtype=np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors))
        _powers, _backs = tables


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all words of all texts, in order; for each text the index of its first word, and one end; bytes; words' starts and stops in them)."""
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    n = len(data)
    _grow(n + 1)
    space = _SPACE[data]
    after = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & after)
    stops = np.flatnonzero(space & ~after)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers[:n])])
    hashes = mix64((sums[stops] - sums[starts]) * _backs[starts] + (stops - starts).astype(np.uint64))
    first_byte = np.concatenate([[0], np.cumsum(sizes + 1)])
    return hashes, np.searchsorted(starts, first_byte), data, starts, stops


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of all texts, in order; for each text the index of its first word, and one end)."""
    return word_spans(texts)[:2]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted. With fewer words the whole sequence is one shingle; without words the set is empty."""
    hashes, first = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(0, n - words + 1), dtype=np.uint64)
    for k in range(words):
        rolled += hashes[k : k + len(rolled)] * _PLACE[k]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            found = np.sort(rolled[a : b - words + 1])
            if len(found) > 1:
                found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            value = (hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64)
            found = mix64(np.array([value], dtype=np.uint64) + np.uint64(b - a))
        else:
            found = np.empty(0, dtype=np.uint64)
        out.append(found)
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted distinct arrays."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
