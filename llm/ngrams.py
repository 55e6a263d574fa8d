"""Which hashed byte n-grams a whole text has, as flags of one fixed table: memory stays the same however long the text."""

from __future__ import annotations

import numpy as np

BITS = 16
#: Bytes a step: long texts go through in pieces that overlap, so no temporary array grows with the text.
STEP = 1 << 20


def _grams(a: np.ndarray, n: int) -> np.ndarray:
    """Codes below 2**16 of the n-grams of a byte array; one- and two-byte codes are exact, longer ones are hashed."""
    if len(a) < n:
        return np.zeros(0, dtype=np.uint32)
    code = a[: len(a) - n + 1].astype(np.uint32)
    for k in range(1, n):
        code = (code << 8 if k < 4 else code * np.uint32(0x9E3779B1)) + a[k : len(a) - n + 1 + k]
    if n > 2:
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    return code


def flag(seen: np.ndarray, data: bytes, sizes: tuple[int, ...]) -> None:
    """Set ``seen[i << 16 | code]`` for every n-gram of ``data``, where n is ``sizes[i]``."""
    for at in range(0, max(1, len(data)), STEP):
        a = np.frombuffer(data[at : at + STEP + max(sizes) - 1], dtype=np.uint8)
        for i, n in enumerate(sizes):
            seen[(i << BITS) + _grams(a, n)] = True


#: Classes of bytes: letters, digits and spaces collapse in runs, any other ASCII byte stands for itself.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[9:14] = 32
_CLASS[10] = 10


def shape(data: bytes) -> bytes:
    """The text's classes of bytes, each run as one."""
    c = _CLASS[np.frombuffer(data, dtype=np.uint8)]
    return c[np.r_[True, c[1:] != c[:-1]]].tobytes() if len(c) else b""


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order; words are runs without ASCII white space."""
    a = np.frombuffer(data, dtype=np.uint8)
    gap = _GAP[a]
    if not len(a) or gap.all():
        return np.zeros(0, dtype=np.uint64)
    start = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    place = np.arange(len(a), dtype=np.uint64)
    place[start[0] :] -= np.repeat(start, np.diff(np.r_[start, len(a)])).astype(np.uint64)
    z = (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(31))) * (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(29)
    z[gap] = 0
    return mix(np.add.reduceat(z, start))


def mix(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def echo(data: bytes) -> bytes:
    """For every word but the first, a letter: ``=`` equal to the word before, ``:`` equal to the last but one, ``.`` new, ``,`` seen before."""
    words = word_hashes(data)
    if not len(words):
        return b""
    out = np.full(len(words), ord("."), dtype=np.uint8)
    first = np.zeros(len(words), dtype=bool)
    first[np.unique(words, return_index=True)[1]] = True
    out[~first] = ord(",")
    out[2:][words[2:] == words[:-2]] = ord(":")
    out[1:][words[1:] == words[:-1]] = ord("=")
    return out[1:].tobytes()
