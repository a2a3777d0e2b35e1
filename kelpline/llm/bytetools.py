"""Vectorised text primitives over the raw UTF-8 buffers of Arrow string columns.

All of them work on slices of at most ``SLICE_BYTES`` (one longer text is a slice of its own), so the
memory of a Python worker does not grow with the number of rows in an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Odd, so that it has an inverse modulo 2**64 and a prefix hash can be shifted back to its start.
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words after A-Z are lower-cased: 0-9, a-z and every byte of a character from U+0080 on.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[65:91] = _IN_WORD[128:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; cached and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        step = np.full(size, base & _MASK, dtype=np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without a copy; nulls have no bytes."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_null()), 0, np.diff(at))
        if int(lengths.sum()) != int(at[-1] - at[0]):
            column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
            return buffers(column)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows of at most ``limit`` text bytes (a longer row stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = buffers(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def _tiles(inside: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that cut no word."""
    lo, n = 0, len(inside)
    while lo < n:
        hi = min(n, lo + size)
        while hi < n:
            gaps = np.flatnonzero(~inside[hi : hi + 4096])
            if len(gaps):
                hi += int(gaps[0])
                break
            hi = min(n, hi + 4096)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts in a slice: (hash, text index, first byte, byte past the end).

    A-Z count as a-z; a word is a run of 0-9, a-z and characters from U+0080 on, and never spans two texts.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] |= inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    ends[tails] |= inside[tails]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(first), np.uint64)
    for lo, hi in _tiles(inside, SLICE_BYTES):
        a, b = np.searchsorted(first, (lo, hi))
        if a == b:
            continue
        low = _LOWER[data[lo:hi]].astype(np.uint64) + np.uint64(1)
        prefix = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(low * powers(_BASE, hi - lo), dtype=np.uint64, out=prefix[1:])
        s, e = first[a:b] - lo, last[a:b] - lo
        hashes[a:b] = mix((prefix[e] - prefix[s]) * powers(_INVERSE, hi - lo)[s])
    return hashes, np.searchsorted(offsets, first, side="right") - 1, first, last


def hash_words(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text, as ``words`` gives them."""
    column = pa.array(texts, pa.string())
    hashes, owner, _, _ = words(*buffers(column))
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [hashes[cuts[i] : cuts[i + 1]] for i in range(len(texts))]


def shingles(hashes: np.ndarray, owner: np.ndarray, n_texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words: (hash, text index). A text of fewer words, but not none, is one shingle."""
    counts = np.bincount(owner, minlength=n_texts)
    m = len(hashes)
    out, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = np.uint64(_BASE)
    if m >= width:
        acc = hashes[: m - width + 1].copy()
        for k in range(1, width):
            acc = acc * factor + hashes[k : m - width + 1 + k]
        whole = owner[: m - width + 1] == owner[width - 1 :]
        out, of = mix(acc[whole]), owner[: m - width + 1][whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        firsts = np.searchsorted(owner, short)
        acc = np.full(len(short), 0x5851F42D4C957F2D, np.uint64) + counts[short].astype(np.uint64)
        for k in range(width - 1):
            on = counts[short] > k
            acc[on] = acc[on] * factor + hashes[firsts[on] + k]
        out, of = np.concatenate([out, mix(acc)]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of
