"""Two-stage suffix sorting of a block of byte strings, in numpy.

Stage one sorts directly only the suffixes that are smaller than their
successor. Stage two induces all others: buckets of equal first symbols are
scanned in order, and every suffix in a finished bucket puts the suffix one
position before it, if that one begins with a larger symbol, at the next free
place of its own bucket."""

from __future__ import annotations

import numpy as np

_SYMBOLS = 7  # 9-bit symbols in one comparison key


def packed(sym: np.ndarray) -> np.ndarray:
    """The next seven symbols of every position in one integer."""
    n = len(sym)
    pad = np.concatenate([sym, np.zeros(_SYMBOLS, sym.dtype)]).astype(np.int64)
    k = np.zeros(n, np.int64)
    for j in range(_SYMBOLS):
        k = (k << 9) | pad[j:n + j]
    return k


def suffix_array(sym: np.ndarray, key: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `sym` (0: end of a string, bytes + 1) in the order of their
    first `depth` symbols at least. key: `packed(sym)`."""
    n = len(sym)
    if not n:
        return np.zeros(0, np.int64)
    # smaller than the successor? equal symbols decide further right
    step = np.sign(np.append(sym[1:], -1).astype(np.int32) - sym)
    decides = np.where(step != 0, np.arange(n), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    small = step[decides] > 0
    # stage one
    b = np.flatnonzero(small)
    b = b[np.argsort(key[b], kind="stable")]
    tie = np.zeros(len(b), bool)
    same = key[b[1:]] == key[b[:-1]]
    group = np.cumsum(np.concatenate([[False], ~same])) if len(b) else np.zeros(0, np.int64)
    for d in range(_SYMBOLS, depth, _SYMBOLS):
        tie[:] = False
        tie[1:] = same
        tie[:-1] |= same
        at = np.flatnonzero(tie)
        if not len(at):
            break
        p = b[at]
        nxt = np.where(p + d < n, key[np.minimum(p + d, n - 1)], -1)
        order = np.lexsort((nxt, group[at]))
        b[at], nxt = p[order], nxt[order]
        split = np.zeros(len(b), bool)
        split[at[1:]] = (nxt[1:] != nxt[:-1])
        same = same & ~split[1:]
        group = np.cumsum(np.concatenate([[False], ~same]))
    # stage two
    first = sym[b]
    bucket_of = np.searchsorted(first, np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    waiting[int(sym[n - 1])].append(np.array([n - 1]))
    out = []
    for c in range(257):
        bucket = []
        if waiting[c]:
            front = np.concatenate(waiting[c])
            while len(front):
                bucket.append(front)
                front = front[front > 0] - 1
                front = front[sym[front] == c]
        bucket.append(b[bucket_of[c]:bucket_of[c + 1]])
        done = np.concatenate(bucket)
        if not len(done):
            continue
        out.append(done)
        before = done[done > 0] - 1
        s = sym[before]
        before, s = before[s > c], s[s > c]
        if len(before):
            order = np.argsort(s, kind="stable")
            before, s = before[order], s[order]
            cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            for x, y in zip(cut, np.append(cut[1:], len(s))):
                waiting[int(s[x])].append(before[x:y])
    return np.concatenate(out)


def long_repeats(sym: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """Mask of positions whose next `size` symbols also start elsewhere in the
    block. left: symbols until the end of the position's string."""
    key = packed(sym)
    sa = suffix_array(sym, key, size)
    hit = np.zeros(len(sym), bool)
    a, b = sa[:-1], sa[1:]
    ok = (left[a] >= size) & (left[b] >= size)
    a, b = a[ok], b[ok]
    # common prefix of neighbours, up to `size`
    for d in [*range(0, size - _SYMBOLS, _SYMBOLS), max(size - _SYMBOLS, 0)]:
        if size < _SYMBOLS:
            raise ValueError("repeats are at least seven bytes long")
        ok = key[a + d] == key[b + d]
        a, b = a[ok], b[ok]
    hit[a] = hit[b] = True
    return hit
