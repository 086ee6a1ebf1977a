"""Vectorised words, word hashes and word windows over a batch of texts.

A word is a run of bytes other than space and \\t..\\r, unchanged (the pattern
``[^\\x20\\x09-\\x0D]+``; these bytes never occur inside a longer UTF-8 sequence).
Hashes are polynomials over per-byte 64-bit values, read off prefix sums, so a
batch costs a few numpy passes whatever the number of words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
#: Odd multipliers of the byte, first and second window polynomials.
_R_BYTE, _R_WIN, _R_WIN2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_BLOCK = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser (xor-shift-multiply) over uint64."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h = h * U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


_LUT = mix((np.arange(256, dtype=np.uint64) + U(1)) * U(0x9E3779B97F4A7C15))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(r: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^0..r^n and their inverses modulo 2^64 (kept per process)."""
    have = _POWERS.get(r)
    if have is None or len(have[0]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        inv = pow(r, -1, 1 << 64)
        pair = []
        for base in (r, inv):
            a = np.full(size + 1, base, np.uint64)
            a[0] = 1
            pair.append(np.cumprod(a))
        have = _POWERS[r] = (pair[0], pair[1])
    return have


class Words:
    """Words of a list of texts: ``start``/``end`` offsets in ``blob``, ``first``
    (index of each text's first word, one more at the end), ``doc`` per word."""

    def __init__(self, texts: list[bytes]):
        self.blob = b"\n".join(texts)
        buf = np.frombuffer(self.blob, np.uint8)
        inside = np.zeros(len(buf) + 2, bool)
        np.logical_not(_SEP[buf], out=inside[1:-1])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.buf, self.start, self.end = buf, edge[0::2], edge[1::2]
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_start = np.concatenate(([0], np.cumsum(size)))[:-1] if len(texts) else np.zeros(0, np.int64)
        self.first = np.append(np.searchsorted(self.start, self.text_start), len(self.start)).astype(np.int64)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.start), np.uint64)
        at, n = 0, len(self.start)
        while at < n:
            lo = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, lo + _BLOCK, side="right")))
            hi = self.end[to - 1]
            up, down = _powers(_R_BYTE, int(hi - lo))
            prefix = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_LUT[self.buf[lo:hi]] * up[: hi - lo], out=prefix[1:])
            s, e = self.start[at:to] - lo, self.end[at:to] - lo
            out[at:to] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
            at = to
        return out

    def windows(self, h: np.ndarray, k: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the first word, hash) of every window of ``k`` words of one text."""
        n = len(h)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1:])
        return at, window_hash(h, k, second)[at]

    def text_hashes(self, h: np.ndarray, second: bool = False) -> np.ndarray:
        """Hash of each text's whole word sequence (its number of words included)."""
        r = _R_WIN2 if second else _R_WIN
        up, down = _powers(r, len(h))
        prefix = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=prefix[1:])
        lo, hi = self.first[:-1], self.first[1:]
        return mix((prefix[hi] - prefix[lo]) * down[lo] + self.count.astype(np.uint64))


def window_hash(h: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """Hash of ``h[i:i+k]`` for every i (len(h) - k + 1 values)."""
    n = len(h)
    out = np.empty(max(0, n - k + 1), np.uint64)
    r = _R_WIN2 if second else _R_WIN
    up, down = _powers(r, min(n, _BLOCK) + k)
    for at in range(0, len(out), _BLOCK):
        to = min(len(out), at + _BLOCK)
        part = h[at: to + k - 1]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=prefix[1:])
        out[at:to] = mix((prefix[k:] - prefix[:-k]) * down[: to - at] + U(k))
    return out
