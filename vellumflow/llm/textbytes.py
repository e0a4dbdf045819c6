"""Texts as byte arrays: words, shingles and window hashes of many documents at once.

An Arrow string column is one buffer of UTF-8 bytes with offsets. The functions
here work on blocks of whole documents of that buffer, so memory is bounded by
``BLOCK_BYTES`` or the longest single text, whichever is larger. Hashes are polynomials over
random byte tables modulo the prime 2^31 - 1, under two bases, joined to 62 bits (modulo a power
of two, some regular texts collide under every base); ``mix`` spreads them over all bits.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 2 << 20
PRIME = (1 << 31) - 1
#: Values that are hashed at a time.
STEP = 1 << 14
BASES = (1_318_914_061, 1_876_543_219)
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LETTER_DIGIT = np.zeros(256, bool)
LETTER_DIGIT[0x30:0x3A] = LETTER_DIGIT[0x61:0x7B] = LETTER_DIGIT[0x80:] = True

#: Distinct values of 18 bits, whose products with powers add up in 64 bits over a step.
_TABLES = np.stack([r.choice(1 << 18, 256, replace=False) + 1 for r in map(np.random.default_rng, (20240101, 20240102))]).astype(np.uint64)
#: Powers of the bases and of their inverses, as far as they were needed.
_state: list[tuple[np.ndarray, np.ndarray]] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def _folded(x: np.ndarray) -> np.ndarray:
    """A value below 2^33 that is ``x`` modulo the prime."""
    return (x & U64(PRIME)) + (x >> U64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x``, below 2^63, modulo the prime."""
    x = _folded(_folded(x))
    return np.subtract(x, U64(PRIME), out=x, where=x >= PRIME)


def _row(base: int, size: int) -> np.ndarray:
    """The powers of a base, by doubling."""
    out = np.ones(size, np.uint32)
    done, step = 1, base
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = _reduced(out[:more].astype(U64) * U64(step))
        done, step = done + more, step * step % PRIME
    return out


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers 0..n and those of its inverse."""
    if not _state or len(_state[0][0]) <= n:
        size = max(n + 1, BLOCK_BYTES + (1 << 16))
        _state[:] = [(_row(base, size), _row(pow(base, -1, PRIME), size)) for base in BASES]
    return _state


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = column.cast(pa.large_binary())
    if a.null_count:
        a = a.fill_null(b"")
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together, or of one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _sums(n: int, products: Callable[[slice, int, np.ndarray], None]) -> np.ndarray:
    """Running sums, one for each base, both in one value; ``products(part, base, out)`` gives what is added, below
    2^49. In steps that stay in the processor's cache."""
    out, carry = np.zeros(n + 1, U64), [U64(0), U64(0)]
    both = np.empty((2, min(n, STEP)), U64)
    for i in range(0, n, STEP):
        part = slice(i, min(i + STEP, n))
        x, high = both[:, : part.stop - i]
        place = out[i + 1 : part.stop + 1]
        for k in range(2):
            products(part, k, x)
            x[0] += carry[k]
            np.cumsum(x, out=x)
            for _ in range(2):
                np.right_shift(x, U64(31), out=high)
                np.bitwise_and(x, U64(PRIME), out=x)
                np.add(x, high, out=x)
            np.minimum(x, x - U64(PRIME), out=x)
            carry[k] = x[-1]
            place |= x << U64(32) if k == 0 else x
    return out


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` turns two of them into the hash of a span."""
    powers = _powers(len(values))

    def products(part: slice, k: int, out: np.ndarray) -> None:
        v = mix(values[part]) if k else values[part]
        out[:] = _folded(_reduced(v >> U64(1)) * powers[k][0][part])

    return _sums(len(values), products)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """The running sums of bytes."""
    powers = _powers(len(data))

    def products(part: slice, k: int, out: np.ndarray) -> None:
        np.take(_TABLES[k], data[part], out=out, mode="clip")
        np.multiply(out, powers[k][0][part], out=out)

    return _sums(len(data), products)


def span_order(prefix: np.ndarray, size: int) -> np.ndarray:
    """A short hash of every span of ``size`` units, in the upper 32 bits; equal bytes give equal values."""
    inverse, low = _powers(len(prefix))[1][1], U64(0xFFFFFFFF)
    out = np.empty(max(0, len(prefix) - size), U64)
    for i in range(0, len(out), STEP):
        j = min(i + STEP, len(out))
        x = _reduced(((prefix[i + size : j + size] & low) + U64(PRIME) - (prefix[i:j] & low)) * inverse[i:j])
        out[i:j] = x * U64(0x9E3779B97F4A7C15) & U64(0xFFFFFFFF00000000)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; equal bytes give equal hashes wherever they stand."""
    (_, first), (_, second) = _powers(len(prefix))
    out, low = np.empty(len(start), U64), U64(0xFFFFFFFF)
    for i in range(0, len(start), STEP):
        at = start[i : i + STEP]
        to, from_ = prefix[end[i : i + STEP]], prefix[at]
        a = _reduced(((to >> U64(32)) + U64(PRIME) - (from_ >> U64(32))) * first[at])
        b = _reduced(((to & low) + U64(PRIME) - (from_ & low)) * second[at])
        out[i : i + STEP] = mix(a << U64(31) | b)
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document) of the maximal runs of allowed bytes;
    ``offsets`` are those of the documents in ``data`` and begin at 0."""
    inside = allowed[data]
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def words(data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word after lower-casing A-Z, first word of each document and the end)."""
    low = LOWER[data]
    start, end, first = word_spans(low, offsets, allowed)
    return span_hash(prefix_hash(low), start, end), first


def documents_of(first: np.ndarray) -> np.ndarray:
    """The document of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
