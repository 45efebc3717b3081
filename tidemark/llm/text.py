"""Words and word shingles as numpy arrays (used inside Arrow tasks)."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
U = np.uint64
_P = 0x9E3779B97F4A7C17  # odd, so it has an inverse modulo 2^64
_STEP = U(_P)
_BACK = U(pow(_P, -1, 1 << 64))
#: texts are hashed in pieces of about so many bytes
PIECE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finaliser with two multiplications)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


#: a pseudo-random word for each byte; blanks (0x20, 0x09-0x0D) end words
_BYTE = mix(np.arange(1, 257, dtype=U))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_STEP, 1 << 14), _powers(_BACK, 1 << 14)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of every word (between ASCII blanks) of UTF-8 bytes, in order:
    the sum of a random number per byte times a power of an odd base, taken
    for all words at once as differences of one running sum."""
    parts, at = [], 0
    while len(raw) - at > 2 * PIECE:
        cut = max(raw.rfind(b, at + 1, at + PIECE) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut < 0:  # a word longer than a piece
            break
        parts.append(_hashes(raw[at:cut]))
        at = cut
    parts.append(_hashes(raw[at:]))
    return np.concatenate(parts)


def _hashes(raw: bytes) -> np.ndarray:
    global _UP, _DOWN
    n = len(raw)
    if n + 1 > len(_UP):
        _UP, _DOWN = _powers(_STEP, 2 * n + 2), _powers(_BACK, 2 * n + 2)
    b = np.frombuffer(raw, np.uint8)
    blank = np.ones(n + 2, bool)
    blank[1:-1] = _BLANK[b]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE[b] * _UP[:n], out=total[1:])
    return mix((total[end] - total[start]) * _DOWN[start] + (end - start).astype(U))


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes, in text order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _STEP
        out += h[j:j + n]
    return mix(out + U(k))


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    s = np.sort(h)
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


def lower_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case."""
    return word_hashes(text.encode("utf-8").lower()) if text else np.empty(0, U)


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a text of fewer words
    has its whole sequence as the only one, a text without words has none."""
    h = lower_hashes(text)
    return distinct(ngram_hashes(h, min(k, len(h)))) if len(h) else h
