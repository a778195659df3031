"""Small frames and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall(t or "")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def corpus(seed: int = 3, n: int = 60, vocabulary: int = 400) -> list[tuple]:
    """(doc_id, text): random words, copies, near copies, shared passages,
    repeated rows, nulls, empty texts and odd separators."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéßñABC") for _ in range(r.randint(1, 9))) for _ in range(vocabulary)]
    pick = (lambda k: [r.choice(vocab) for _ in range(k)])
    passage = pick(40)
    docs = []
    for i in range(n):
        w = pick(r.choice([1, 3, 4, 5, 12, 13, 14, 40, 90]))
        if i % 4 == 1:
            at = r.randint(0, len(w))
            w[at:at] = passage[r.randint(0, 10):r.randint(20, 40)]
        if i % 5 == 2 and docs:
            w = words(docs[r.randrange(len(docs))][1])
            if w and i % 2:
                w[r.randrange(len(w))] = "changed"
        docs.append((i * 3 % 97, r.choice(["", " "]) + r.choice([" ", "\t ", "\n"]).join(w)))
    docs += [(200, None), (201, ""), (202, " \n\t"), docs[5], docs[9], (None, docs[3][1]), (None, None),
             (203, "x" * 5000), (204, "x" * 5000 + " tail"), (205, "ab " * 700)]
    r.shuffle(docs)
    return docs


def brute_factor(docs, window: int = 13):
    first: dict = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def brute_bytes(docs, size: int):
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(b[k:k + size] for b in raw for k in range(len(b) - size + 1))
    out = []
    for (i, _), b in zip(docs, raw):
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def brute_contamination(docs, items, window: int = 13):
    grams = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        if i is None or not w:
            continue
        n = min(window, len(w))
        for k in range(len(w) - n + 1):
            grams[tuple(w[k:k + n])].add(str(i))
    out = []
    for i, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in range(1, window + 1):
            for k in range(len(w) - n + 1):
                g = grams.get(tuple(w[k:k + n]))
                if g:
                    hit.update(range(k, k + n))
                    found |= g
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def union_find(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingle_set(t, gram: int = 5):
    w = words((t or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + gram]) for k in range(max(len(w) - gram + 1, 1)))


def brute_similar(docs):
    sets = [(i, shingle_set(t)) for i, t in docs]
    own = [(i, s) for i, s in sets if i is not None and s]
    links = [(a, b) for k, (a, x) in enumerate(own) for b, y in own[:k]
             if 100 * len(x & y) >= 75 * len(x | y)]
    comp = union_find({i for i, _ in own}, links)
    # a row without words is linked with nothing
    return [(i, len(s), comp[i] if i is not None and s else i) for i, s in sets]


def brute_lines(docs, similar: int = 80):
    low = (lambda b: bytes(x + 32 if 65 <= x <= 90 else x for x in b))
    cls = defaultdict(list)
    for i, t in docs:
        for k, x in enumerate((t or "").encode().split(b"\n")):
            if x.strip(b" \t\n\x0b\x0c\r") and i is not None:
                cls[low(x)].append((i, k))
    keys = sorted(cls)
    sets = [{x[j:j + 8] for j in range(max(len(x) - 7, 1))} for x in keys]
    links = [(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets[:a])
             if 100 * len(x & y) >= similar * len(x | y)]
    comp = union_find(range(len(keys)), links)
    first: dict = {}
    for a, x in enumerate(keys):
        first[comp[a]] = min(first.get(comp[a], (1 << 60, 0)), min(cls[x]))
    at = {x: a for a, x in enumerate(keys)}
    out = []
    for i, t in docs:
        raw = (t or "").encode().split(b"\n")
        solid = [k for k, x in enumerate(raw) if x.strip(b" \t\n\x0b\x0c\r")]
        gone = {k for k in solid if i is not None and first[comp[at[low(raw[k])]]] != (i, k)}
        kept = b"".join(x + (b"\n" if k < len(raw) - 1 else b"") for k, x in enumerate(raw) if k not in gone)
        out.append((i, len(solid), len(gone), sha(kept)))
    return out


def ordered(rows):
    return sorted((tuple(x) for x in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
