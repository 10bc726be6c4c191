"""Texts as flat byte arrays: words, lines, hashes and sliding minima in numpy.

All functions work on one slice of an Arrow batch.  Hashes are polynomials
modulo 2**64 over random-looking symbol values, finished by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The bytes of the word rule [^\x20\x09-\x0D]+.
WHITESPACE = (9, 10, 11, 12, 13, 32)
# Multipliers of the mixer and bases of the polynomials: any odd numbers do.
MIX_1, MIX_2, STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)


def flags(members) -> np.ndarray:
    """A table of 256 booleans."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def slices(batch, limit: int) -> Iterator:
    """Row slices whose texts take at most ``limit`` bytes, or one row each."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0)
    if isinstance(sizes, pa.ChunkedArray):
        sizes = sizes.combine_chunks()
    sums = np.cumsum(np.asarray(sizes, dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        before = sums[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sums, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if offsets is not None and len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def totals(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and text numbers of all words."""
    inside = ~flags(WHITESPACE)[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][some], offsets[1:][some] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), base)[:len(values)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of spans, from the sums of ``prefix_sums``."""
    back = powers(int(starts.max()) + 1 if len(starts) else 1, pow(base, -1, 1 << 64))
    spans = (sums[ends] - sums[starts]) * back[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(STEP))


def byte_values(seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed)) * np.uint64(STEP))


def text_hashes(data, starts, ends, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    base = BASES[seed % 2]
    return span_hashes(prefix_sums(byte_values(seed)[data], base), starts, ends, base)


# Values handled at a time where neighbours are all that matters: fits the cache.
BLOCK = 1 << 15


def grams(values: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values (empty if there are fewer)."""
    base = BASES[seed % 2]
    count = max(0, len(values) - n + 1)
    out = np.empty(count, np.uint64)
    ahead, back = powers(BLOCK + n, base), powers(BLOCK, pow(base, -1, 1 << 64))
    salt = np.uint64(n * STEP & 0xFFFFFFFFFFFFFFFF)
    for a in range(0, count, BLOCK):
        part = values[a:a + BLOCK + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * ahead[:len(part)], out=sums[1:])
        runs = sums[n:] - sums[:-n]
        runs *= back[:len(runs)]
        runs += salt
        out[a:a + BLOCK] = mix(runs)
    return out


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each run of ``width`` values (by their upper halves)."""
    count = max(0, len(values) - width + 1)
    out = np.empty(count, np.int64)
    rows = -(-(BLOCK + width - 1) // width) + 1
    place = np.arange(rows * width, dtype=np.int32).reshape(rows, width)
    for a in range(0, count, BLOCK):
        part = (values[a:a + BLOCK + width - 1] >> np.uint64(32)).astype(np.uint32)
        n = len(part)
        grid = np.full(rows * width, 0xFFFFFFFF, np.uint32)
        grid[:n] = part
        grid = grid.reshape(rows, width)
        fore = np.minimum.accumulate(grid, axis=1)
        falls = np.ones((rows, width), bool)
        falls[:, 1:] = grid[:, 1:] < fore[:, :-1]
        fore_at = np.maximum.accumulate(np.where(falls, place, 0), axis=1)
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]
        falls[:, :] = True
        falls[:, :-1] = grid[:, :-1] <= back[:, 1:]
        far = np.where(falls, place, rows * width)
        back_at = np.minimum.accumulate(far[:, ::-1], axis=1)[:, ::-1]
        fore, fore_at, back, back_at = (x.reshape(-1) for x in (fore, fore_at, back, back_at))
        left, right = slice(0, n - width + 1), slice(width - 1, n)
        out[a:a + BLOCK] = np.where(back[left] <= fore[right], back_at[left], fore_at[right])
        out[a:a + BLOCK] += a
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``width`` from one of ``starts``."""
    edges = np.zeros(n + 1, np.int32)
    edges[:len(edges)] += np.bincount(starts, minlength=n + 1)[:n + 1].astype(np.int32)
    edges -= np.bincount(np.minimum(starts + width, n), minlength=n + 1).astype(np.int32)
    return np.cumsum(edges[:n]) > 0


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it found twice or more; is it equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def word_array(data, starts, ends) -> pa.LargeStringArray:
    """The words as one Arrow array."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1              # words don't overlap, so each end is there once
    packed = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed)))
