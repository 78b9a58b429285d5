"""Word and shingle hashes of whole texts, computed on Arrow buffers with numpy.

Words are maximal runs of bytes other than space and \\t\\n\\v\\f\\r, after lower-casing A-Z.
A word's hash is a polynomial over its bytes modulo 2**64, mixed; a shingle's hash combines
those of its words. 64 bits: among the shingles of two documents a collision is not to be
expected, and it could only make an overlap one too large.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from estrato.llm.common import SPACE, Texts

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[65:91] += 32
PLAIN[[ord(c) for c in SPACE]] = 32

# The same with ASCII punctuation as white space.
NO_MARKS = PLAIN.copy()
NO_MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """All words of a batch: hash, start and end byte, and where each text's words begin."""

    def __init__(self, texts: Texts, normal: np.ndarray = PLAIN):
        found = [_piece(texts.data, a, b, texts.ends, normal) for a, b in _cuts(texts, normal)]
        self.hashes, self.starts, self.stops = (
            np.concatenate([f[i] for f in found]) if found else np.empty(0, kind)
            for i, kind in enumerate((np.uint64, np.int64, np.int64))
        )
        self.first = np.searchsorted(self.starts, texts.ends)


def _cuts(texts: Texts, normal: np.ndarray):
    """Stretches of about PIECE bytes that split no word."""
    at, end = int(texts.ends[0]), int(texts.ends[-1])
    while at < end:
        to = min(at + PIECE, end)
        last = int(texts.ends[np.searchsorted(texts.ends, to, "right") - 1])
        if last > at:
            to = last
        else:
            stop = int(texts.ends[np.searchsorted(texts.ends, to)])
            while to < stop:
                gap = np.flatnonzero(normal[texts.data[to : min(to + PIECE, stop)]] == 32)
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(to + PIECE, stop)
        yield at, to
        at = to


def _piece(data: np.ndarray, a: int, b: int, ends: np.ndarray, normal: np.ndarray):
    part = normal[data[a:b]]
    inside = part != 32
    border = np.zeros(b - a + 1, bool)
    cut = ends[np.searchsorted(ends, a) : np.searchsorted(ends, b, "right")] - a
    border[cut] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    after = np.concatenate((inside[1:], [False]))
    stops = np.flatnonzero(inside & (~after | border[1:])) + 1
    size = PIECE
    while size < b - a + 1:
        size *= 2
    up, down = _powers(size)
    sums = np.zeros(b - a + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: b - a], out=sums[1:])
    h = (sums[stops] - sums[starts]) * down[starts]
    return mix(h + (stops - starts).astype(np.uint64)), starts + a, stops + a


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and for each whether its text holds them."""
    h, n = words.hashes, len(words.hashes)
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)
    out = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        out[: n - j] = mix(out[: n - j] * _BASE + h[j:] + np.uint64(j + 1))
    return out, left >= k


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer than k words, one for all."""
    every, _ = shingles(words, k)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= k:
            sets.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            few = np.array([b - a], np.uint64)
            for i in range(a, b):
                few = mix(few * _BASE + words.hashes[i : i + 1])
            sets.append(few)
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
