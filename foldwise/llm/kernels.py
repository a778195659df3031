"""Vectorised text kernels shared by the operators of this subpackage.

They work on the UTF-8 buffer of an Arrow string column, one slice of bounded
size at a time, and never look at a text character by character."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

U = np.uint64
SLICE_BYTES = 4 << 20

# separators of `[^\x20\x09-\x0D]+`
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# complement of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (digits, a-z and non-ASCII stay)
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[0x00:0x30] = NON_ALNUM[0x3A:0x61] = NON_ALNUM[0x7B:0x80] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_K0, _K1, _K2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    h = (h ^ (h >> U(30))) * _K1
    h = (h ^ (h >> U(27))) * _K2
    return h ^ (h >> U(31))


class Texts:
    """The texts of one slice: `data` (uint8), `off` (row offsets into it,
    starting at 0) and `valid` (False where the text is null)."""

    def __init__(self, col: pa.Array, lower: bool = False):
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        kind = np.int64 if wide else np.int32
        bufs = col.buffers()
        n = len(col)
        off = (np.frombuffer(bufs[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
               if n else np.zeros(1, np.int64))
        data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
        data = data[off[0]:off[-1]]
        self.off = off - off[0]
        self.data = LOWER[data] if lower else data
        self.valid = ~np.asarray(col.is_null()) if col.null_count else np.ones(n, bool)
        self.n = n

    def load8(self) -> np.ndarray:
        """8 bytes from every position as little-endian integers (zero padded)."""
        pad = np.concatenate([self.data, np.zeros(40, np.uint8)])
        return np.ndarray((len(self.data) + 32,), "<u8", pad, 0, (1,))

    def words(self, sep: np.ndarray):
        """(starts, ends, word offsets of each row)."""
        n = len(self.data)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.n + 1, np.int64)
        w = ~sep[self.data]
        before = np.empty(n, bool)
        before[0], before[1:] = False, w[:-1]
        b = self.off[:-1]
        before[b[b < n]] = False
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, w[1:]
        e = self.off[1:] - 1
        after[e[e >= 0]] = False
        starts = np.flatnonzero(w & ~before)
        ends = np.flatnonzero(w & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.off)

    def word_hash(self, starts, ends) -> np.ndarray:
        """64-bit hash of each word, eight bytes at a time."""
        size = ends - starts
        v = self.load8()
        h = mix((v[starts] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * _K0)
        at, k = np.flatnonzero(size > 8), 8
        while len(at):
            left = np.minimum(size[at] - k, 8)
            h[at] = mix((h[at] * _K0) ^ (v[starts[at] + k] & _MASK[left]))
            k += 8
            at = at[size[at] > k]
        return h


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _K0)


def byte_gram32(t: Texts) -> np.ndarray:
    """Hash of every 32 consecutive bytes."""
    n = len(t.data) - 31
    if n <= 0:
        return np.zeros(0, np.uint64)
    v = t.load8()
    g = v[:n] * _K0
    for j in (8, 16, 24):
        g += v[j:n + j]
        g *= _K1 if j != 16 else _K2
    return mix(g)


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive items (row borders are not looked at)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n] * _K2
    for j in range(1, k):
        g = (g + h[j:n + j]) * _K2
    return mix(g)


def run_hash(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the items [start, stop) for many ranges, by prefix sums."""
    p = np.multiply.accumulate(np.full(len(h) + 1, _K0, np.uint64))
    s = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[:-1], out=s[1:])
    # divide by p[start]: multiply by the inverse power
    inv = U(pow(int(_K0), -1, 1 << 64))
    q = np.multiply.accumulate(np.full(len(h) + 1, inv, np.uint64))
    return mix((s[stop] - s[start]) * q[start] + (stop - start).astype(np.uint64) * _K1)


def within_rows(bounds: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask over window starts 0..n-1: True where `size` items lie in one row."""
    ok = np.zeros(max(n, 0), bool)
    if n <= 0:
        return ok
    change = np.zeros(n + 1, np.int32)
    a, b = bounds[:-1], bounds[1:] - size + 1
    good = b > a
    np.add.at(change, a[good], 1)
    np.add.at(change, b[good], -1)
    return np.cumsum(change[:-1]) > 0


def window_min_at(g: np.ndarray, w: int, block: int = 1 << 20) -> np.ndarray:
    """Position of the smallest of every w consecutive hashes; of equal ones
    the leftmost. The hash keeps 40 bits in the comparison, the position 24."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = U((1 << 24) - 1)
    out = np.empty(n, np.int64)
    for s in range(0, n, block):
        m = g[s:min(s + block, n) + w - 1]
        m = (m & ~low) | np.arange(len(m), dtype=np.uint64)
        size, total = 1, len(m)
        while size * 2 <= w:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < w:
            k = total - w + 1
            m = np.minimum(m[:k], m[w - size:w - size + k])
        out[s:s + block] = (m & low).astype(np.int64) + s
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch so that a slice holds at most `limit` bytes of text, or one
    row when a text alone is longer."""
    n = batch.num_rows
    if not n:
        return
    t = batch.column(column)
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(t), 0)).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < n:
        stop = int(np.searchsorted(total, total[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), n)
        yield batch.slice(at, stop - at)
        at = stop


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values, ascending. Sorting beats the hash table that
    `np.unique` fills by far."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def in_both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The common values of two ascending arrays without repeats."""
    both = np.sort(np.concatenate([x, y]), kind="stable")  # merges the two runs
    return both[1:][both[1:] == both[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+size-1."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(total)
