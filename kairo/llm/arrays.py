"""Vectorised text helpers used inside Arrow map tasks.

A task sees its rows as Arrow batches.  ``slices`` cuts a batch into pieces of
at most ``limit`` text bytes (a longer text is a piece of its own), so the
numpy temporaries stay small whatever the batch size; all functions work on
the piece's bytes with document offsets, never across documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse mod 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


# freed batches go back to the system instead of staying with the worker
pa.set_memory_pool(pa.system_memory_pool())


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * U64(2) + U64(1)


_BYTE = seeds(256, 1)
_COEF = seeds(64, 2)
_power = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse."""
    global _power
    if len(_power[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_BASE, _INVERSE):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _power = tuple(out)
    return _power


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the word."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes ``H`` (length n+1, mod 2**64)."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * powers(len(buf) + 1)[0][:len(buf)], out=out[1:])
    return out


def range_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``buf[start:end]``, independent of where the range stands."""
    return (h[end] - h[start]) * powers(len(h) + 1)[1][start]


#: Primes below 2**31: a polynomial modulo a prime has no texts that collide whatever
#: the base, as one modulo a power of two has.
_PRIMES = (2_147_483_647, 2_147_483_629)
_residues: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _prime_powers(p: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, modulo ``p``."""
    if p not in _residues or len(_residues[p][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = []
        for base in (_BASE % p, pow(_BASE % p, -1, p)):
            a, m = np.ones(size, np.uint64), 1
            while m < size:                      # the second half is the first one, shifted
                a[m:2 * m] = a[:m] * U64(pow(base, m, p)) % U64(p)
                m *= 2
            out.append(a)
        _residues[p] = tuple(out)
    return _residues[p]


def prime_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """62-bit hashes of the ranges: two polynomials, each modulo its prime."""
    out = np.zeros(len(start), np.uint64)
    for p in _PRIMES:
        power, inverse = _prime_powers(p, len(buf) + 1)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((_BYTE[buf] % U64(p)) * power[:len(buf)] % U64(p), out=total[1:])
        h = (total[end] - total[start]) % U64(p) * inverse[start] % U64(p)
        out = out << U64(31) | h
    return out


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as text; null reads as the empty text."""
    col = batch.column(batch.schema.get_field_index(name))
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, without copying."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, off


def slices(col: pa.Array, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first_row, end_row, bytes, offsets)``; offsets start at 0."""
    data, off = raw(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return _LOWER[buf]


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes other than space and \\t-\\r, as
    ``(start, end, first_word)``; document d has words
    ``first_word[d]:first_word[d + 1]``."""
    n = len(buf)
    text = ~_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = text.copy()
    start[1:] &= ~text[:-1] | edge[1:n]
    end = text.copy()
    end[:-1] &= ~text[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(prime_hashes(buf, start, end) + (end - start).astype(U64) * _COEF[-1])


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every document (``h``: word hashes);
    a document of 1 to k-1 words has its whole sequence as its only shingle.
    Returns ``(hash, first_shingle)``."""
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out_first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(out_first[-1]) - np.repeat(out_first[:-1] - first[:-1], n)
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    left = np.repeat(np.minimum(count, k), n)
    for j in range(k):
        part = padded[at + j] * _COEF[j]
        if j and len(left) and left.min() <= j:
            part[left <= j] = 0
        total += part
    return mix(total), out_first


def per_document(values: np.ndarray, first: np.ndarray, op: np.ufunc, empty) -> np.ndarray:
    """``op.reduceat`` by document, with ``empty`` for documents of no value."""
    n = len(first) - 1
    out = np.full(n, empty, values.dtype)
    some = first[1:] > first[:-1]
    if some.any():
        out[some] = op.reduceat(values, first[:-1][some])
    return out


def distinct_sorted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every document, as ``(values, first)``."""
    values = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[first[:-1][first[:-1] < len(values)]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], total[first]
