"""Vectorised word hashing of whole texts held in Arrow arrays.

Words are maximal runs of bytes outside {0x20, 0x09-0x0D}.  A word's hash is a
polynomial over its bytes modulo 2^64 (each byte first mapped to a fixed random
64-bit value), computed for all words of a block from one prefix sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POW.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _POW[name] = have = np.multiply.accumulate(p)
    return have[:n]


@dataclass
class Block:
    """Documents ``lo..hi`` of a batch; words of document i are ``off[i-lo]:off[i-lo+1]``."""

    lo: int
    hi: int
    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    off: np.ndarray


def blocks(texts: pa.Array, lower: bool = False, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Hash the words of every text, a few documents at a time; null texts have no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = texts.cast(pa.large_binary())
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + block_bytes, "right")) - 1)
        buf = data[offs[lo]:offs[hi]]
        yield _block(lo, hi, buf, offs[lo:hi + 1] - offs[lo], lower)
        lo = hi


def _block(lo: int, hi: int, buf: np.ndarray, doc: np.ndarray, lower: bool) -> Block:
    n = len(buf)
    word = ~_SPACE[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cut = doc[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = word[cut]
    last = word.copy()
    if n:
        last[:-1] &= ~word[1:]
        last[cut - 1] = word[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    terms = (_LOWER if lower else _BYTE)[buf]
    terms *= _powers("r", _R, n)
    np.cumsum(terms, out=total[1:])
    h = (total[end] - total[start]) * _powers("rinv", _RINV, n + 1)[start]
    h = mix(h + (end - start).astype(np.uint64))
    return Block(lo, hi, buf, start, end, h, np.searchsorted(start, doc))


def window_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (document borders not looked at)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(0x9DDFEA08EB382D69)
        out += h[k:len(h) - n + 1 + k]
    return mix(out)


def inside(off: np.ndarray, n: int, total: int) -> np.ndarray:
    """Starts of windows of ``n`` words that stay within one document."""
    ok = np.ones(max(0, total - n + 1), bool)
    for k in range(1, n):
        at = off[1:-1] - k
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    return ok
