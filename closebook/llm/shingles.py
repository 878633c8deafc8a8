"""Hashed word shingles of texts, whole batches at a time in numpy."""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, step = 1, base
    while done < n:  # doubles the known part: base^(done..2 done) = base^done * base^(0..done)
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done * 2, step * step % (1 << 64)
    return out


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every ASCII-lowered word (run of non-blank bytes), and the number of words of each text."""
    _, _, _, hashes, counts = words_of(texts, _BLANK)
    return hashes, counts


def words_of(texts: list[str | None], blank_bytes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The ASCII-lowered bytes of all texts, where words start and end in them, the words' hashes, and the number of
    words of each text; ``blank_bytes`` says of each byte whether it separates words (a space must)."""
    parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    blank = blank_bytes[data]
    data = _LOWER[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return data, starts, ends, np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    # Hash of bytes b at places i: the sum of (b + 1) * base^i, made independent of the place by the inverse.
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)))
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = (sums[ends - 1] - before) * _powers(_INVERSE, len(data))[starts]
    hashes = mix64(hashes ^ mix64((ends - starts).astype(np.uint64)))
    stops = np.cumsum([len(p) + 1 for p in parts])
    return data, starts, ends, hashes, np.diff(np.searchsorted(starts, stops), prepend=0)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending within it, and their number.

    A text of fewer words than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    n_shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), n_shingles)
    first = np.repeat(np.cumsum(counts) - counts, n_shingles)
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    start = first + inside
    stop = np.repeat(np.cumsum(counts), n_shingles)
    hashes = np.zeros(len(doc), dtype=np.uint64)
    for k in range(width):
        there = start + k < stop
        word = np.where(there, words[np.minimum(start + k, max(len(words) - 1, 0))] if len(words) else 0, np.uint64(0))
        hashes = mix64(hashes * np.uint64(31) + word + np.uint64(k + 1))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(texts)).astype(np.int64)
