"""Word shingles of whole texts as sets of 64-bit hashes, in numpy.

A-Z are lower-cased, words are runs of anything but ASCII white space. Words are hashed
by prefix sums of a polynomial over their bytes, shingles by a polynomial over their
words. Texts are read in pieces that end at white space, so memory stays near the size
of one text.
"""

from __future__ import annotations

import hashlib

import numpy as np

from korvane.llm.common import mix64

#: Bytes hashed at once.
PIECE = 1 << 16
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTE[_SPACE] = 0


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _INV = _powers(_P, PIECE + 1), _powers(pow(_P, -1, 2**64), PIECE + 1)


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of UTF-8 text begins and ends, in bytes."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ~_SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(inside))
    return edge[::2], edge[1::2]


def word_hashes(low: bytes) -> np.ndarray:
    """A hash for each word of lower-cased UTF-8 text, in order."""
    global _POW, _INV
    out, at = [], 0
    while at < len(low):
        end = min(len(low), at + PIECE)
        if end < len(low):  # end at white space, however far it is
            cut = next((i for i in range(end, at, -1) if _SPACE[low[i - 1]]), 0)
            while not cut and end < len(low) and not _SPACE[low[end]]:
                end += 1
            end = cut or end
        b = np.frombuffer(low, np.uint8, end - at, at)
        if len(b) >= len(_POW):
            _POW, _INV = _powers(_P, len(b) + 1), _powers(pow(_P, -1, 2**64), len(b) + 1)
        inside = np.empty(len(b) + 2, np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = ~_SPACE[b]
        edge = np.flatnonzero(np.diff(inside))
        first, last = edge[::2], edge[1::2]
        if len(first):
            sums = np.empty(len(b) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE[b] * _POW[: len(b)], out=sums[1:])
            out.append(mix64((sums[last] - sums[first]) * _INV[first] + (last - first).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased (bytes.lower leaves other bytes alone)."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values of an array that it may sort in place."""
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of width words; of the whole sequence where there are fewer; empty without words."""
    words = word_hashes(lowered(text))
    if not len(words):
        return words
    take = min(width, len(words))
    runs = len(words) - take + 1
    total = np.full(runs, take, np.uint64)
    for j, q in enumerate(_powers(_Q, take).tolist()):
        total += words[j : j + runs] * np.uint64(q)
    return distinct(mix64(total))


def set_digest(values: np.ndarray) -> bytes:
    """16 bytes that name a set of shingles."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
