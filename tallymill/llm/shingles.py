"""Hashed word shingles of texts, computed on whole byte arrays at once.

A word is a maximal run of ASCII letters and digits and of any characters beyond ASCII, in
lower case. A shingle is five words in a row; a text of one to four words is one shingle,
a text without words has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np

WORDS = 5
#: Bytes hashed in one go; a longer text is cut between words.
SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ORDER = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 to the 64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    ones = np.ones(n, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = _BASE, inverse
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@cache
def _inside() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return table


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and begin of each word of ``data``: polynomials by differences of one running sum."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.diff(_inside()[raw].astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    size = SEGMENT if len(raw) <= SEGMENT else len(raw)
    up, down = _powers(size)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)])
    return mix((sums[ends] - sums[begins]) * down[begins]), begins


def _segments(data: bytes) -> Iterator[bytes]:
    at = 0
    inside = _inside()
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data) and inside[data[end - 1]] and inside[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(texts: list[str]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    waiting: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, begins = _hash_words(b"\n".join(waiting))
        starts = np.cumsum([0, *(len(x) + 1 for x in waiting)])
        cuts = np.searchsorted(begins, starts)
        for i in range(len(waiting)):
            yield hashes[cuts[i] : cuts[i + 1]]

    for text in texts:
        data = text.lower().encode()
        if len(data) >= SEGMENT:
            if waiting:
                yield from flush()
                waiting, size = [], 0
            yield np.concatenate([_hash_words(x)[0] for x in _segments(data)])
            continue
        if size + len(data) + 1 > SEGMENT:
            yield from flush()
            waiting, size = [], 0
        waiting.append(data)
        size += len(data) + 1
    if waiting:
        yield from flush()


def shingles(words: np.ndarray) -> np.ndarray:
    """The shingle hashes of a text, in order, repeats included."""
    n = len(words)
    if n < WORDS:
        return mix((words * _ORDER[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)) if n else words
    total = words[: n - WORDS + 1] * _ORDER[0]
    for i in range(1, WORDS):
        total = total + words[i : n - WORDS + 1 + i] * _ORDER[i]
    return mix(total)


def digest(words: np.ndarray) -> bytes | None:
    """Names the words of a text in order; None if there are none."""
    return hashlib.md5(words.tobytes(), usedforsecurity=False).digest() if len(words) else None
