"""Benchmark decontamination by training suffix arrays (operator 9).

Every slice of documents a task holds is a shard. The shard's word suffixes
that begin like some test suffix (same first words, `LEAD` of them) are sorted
into a suffix array, and all test suffixes are binary-searched in it at once,
one word deeper per step, down to the window length. Suffixes that begin
otherwise cannot lie in any searched range, so they are not sorted. What is
left after the last step are ranges of the suffix array: all verbatim
occurrences of the window in the shard, with their places. A document is
whole inside one shard, so documents are never shuffled.

The test set is read in blocks of at most `BLOCK_BYTES` of text, chosen by a
hash of the item. The blocks are gathered one after the other, each is broadcast
until the result is computed, and one pass over the corpus serves a block; so the
driver holds the test set. Several blocks are merged by document.

Null or empty texts have no words. Items with a null id or without words are
left out. Documents with equal or null ids are judged row by row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, union_all
from .kernels import NON_ALNUM, Texts, gram_hash, slices, within_rows

WINDOW = 13
LEAD = 4
BLOCK_BYTES = 32 << 20


class TestSuffixes:
    """All windows of one block of test items: word hashes, one row for each
    different window, and the items it stands in."""

    def __init__(self, ids: list, texts: list, window: int):
        t = Texts(pa.array(texts, pa.string()), lower=True)
        starts, ends, wo = t.words(NON_ALNUM)
        h = t.word_hash(starts, ends)
        self.ids = ids
        self.window = window
        rows, sizes, owner = [], [], []
        for i in range(len(ids)):
            a, b = int(wo[i]), int(wo[i + 1])
            size = min(window, b - a)
            if size:
                at = np.arange(a, b - size + 1)
                rows.append(at)
                sizes.append(np.full(len(at), size))
                owner.append(np.full(len(at), i))
        cat = (lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
        at, size, owner = cat(rows), cat(sizes), cat(owner)
        # words of each window, 0 beyond a short item's end
        col = np.arange(window)
        padded = np.concatenate([h, np.zeros(window, np.uint64)])
        w = np.where(col < size[:, None], padded[at[:, None] + col], np.uint64(0))
        key = np.concatenate([size[:, None].astype(np.uint64), w], axis=1)
        if len(key):
            _, first, inv = np.unique(key, axis=0, return_index=True, return_inverse=True)
            inv = inv.ravel()
        else:
            first, inv = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words, self.size = w[first], size[first]
        pairs = np.unique(np.stack([inv, owner], 1), axis=0) if len(inv) else np.zeros((0, 2), np.int64)
        # each window's places, as (item, first word)
        self.where: list[list] = [[] for _ in first]
        for x, a, i in zip(inv.tolist(), at.tolist(), owner.tolist()):
            self.where[x].append((i, a - int(wo[i])))
        self.item_window = np.minimum(np.diff(wo), window)
        self.item_from = np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        self.items = pairs[:, 1]
        # the leading words that a shard's suffix must share with a test suffix
        self.lead = {}
        for k in range(1, LEAD + 1):
            which = np.flatnonzero(self.size >= LEAD if k == LEAD else self.size == k)
            if len(which):
                g = gram_hash(np.ascontiguousarray(self.words[which, :k]).ravel(), k)[::k]
                self.lead[k] = (which, g, np.unique(g))

    def search(self, h: np.ndarray, wo: np.ndarray):
        """Occurrences in a shard with word hashes `h` and row borders `wo`:
        (word position, window) pairs."""
        pos, win = [], []
        for k, (which, g, known) in self.lead.items():
            lead = gram_hash(h, k)
            bits = np.zeros(1 << 16, bool)
            bits[known >> np.uint64(48)] = True
            near = np.flatnonzero(bits[lead >> np.uint64(48)])
            i = np.minimum(np.searchsorted(known, lead[near]), len(known) - 1)
            near = near[known[i] == lead[near]]
            near = near[within_rows(wo, k, len(lead))[near]]
            if not len(near):
                continue
            # suffix array of the shard, sorted to the depth of a window
            deep = self.window if k == LEAD else k
            padded = np.concatenate([h, np.zeros(self.window, np.uint64)])
            row_end = wo[np.searchsorted(wo, near, "right")]
            cols = [lead[near]]
            for d in range(k, deep):
                cols.append(np.where(near + d < row_end, padded[near + d], np.uint64(0)))
            order = np.lexsort(cols[::-1])
            sa, cols = near[order], [c[order] for c in cols]
            lo = np.searchsorted(cols[0], g, "left")
            hi = np.searchsorted(cols[0], g, "right")
            q = which
            rank = np.concatenate([[0], np.cumsum(cols[0][1:] != cols[0][:-1])])
            for d in range(k, deep + 1):
                live = hi > lo
                q, lo, hi = q[live], lo[live], hi[live]
                done = self.size[q] == d
                for a, b, x in zip(lo[done], hi[done], q[done]):
                    pos.append(sa[a:b])
                    win.append(np.full(b - a, x))
                q, lo, hi = q[~done], lo[~done], hi[~done]
                if not len(q):
                    break
                # one word deeper: binary search of (rank so far, next word)
                c = cols[d - k + 1]
                vocab, ident = np.unique(c, return_inverse=True)
                want = self.words[q, d]
                v = np.minimum(np.searchsorted(vocab, want), len(vocab) - 1)
                key = rank * len(vocab) + ident.ravel()
                mine = np.where(vocab[v] == want, rank[lo] * len(vocab) + v, -1)
                lo = np.searchsorted(key, mine, "left")
                hi = np.searchsorted(key, mine, "right")
                rank = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        cat = (lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
        return cat(pos), cat(win)

    def judge(self, col: pa.Array):
        """For a slice of texts: words and hit words of each row, borders of
        the rows, the positions of the hit words, and the items of each row."""
        t = Texts(col, lower=True)
        starts, ends, wo = t.words(NON_ALNUM)
        pos, win = self.search(t.word_hash(starts, ends), wo)
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, pos, 1)
        np.add.at(cover, pos + self.size[win], -1)
        hits = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        n_hit = np.diff(np.searchsorted(hits, wo))
        row = np.searchsorted(wo, pos, "right") - 1
        items: list[set] = [set() for _ in range(t.n)]
        if len(row):
            for r, x in np.unique(np.stack([row, win], 1), axis=0).tolist():
                items[r].update(self.items[self.item_from[x]:self.item_from[x + 1]].tolist())
        return np.diff(wo), n_hit, wo, hits, items

    def places(self, col: pa.Array):
        """Longest verbatim matches of a slice: (row, first word, words, item,
        first word in the item's window list). Occurrences that go on in both
        texts are one match."""
        t = Texts(col, lower=True)
        starts, ends, wo = t.words(NON_ALNUM)
        pos, win = self.search(t.word_hash(starts, ends), wo)
        at, item, place = [], [], []
        for p, x in zip(pos.tolist(), win.tolist()):
            for i, j in self.where[x]:
                at.append(p)
                item.append(i)
                place.append(j)
        at, item, place = (np.array(x, np.int64) for x in (at, item, place))
        row = np.searchsorted(wo, at, "right") - 1
        order = np.lexsort((at, place - at, item, row))
        at, item, place, row = at[order], item[order], place[order], row[order]
        if not len(at):
            return []
        new = np.ones(len(at), bool)
        new[1:] = ((row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1)
                   | (place[1:] != place[:-1] + 1))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        length = at[last] - at[first] + self.item_window[item[first]]
        return [(int(r), int(a), int(n), self.ids[i], int(j)) for r, a, n, i, j in
                zip(row[first], at[first] - wo[row[first]], length, item[first], place[first])]


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[tuple[list, list]]:
    """The test items, gathered a block of bounded bytes at a time."""
    b = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    total = b.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = 1 if total <= limit else -(-total * 2 // limit)
    for k in range(n):
        part = b if n == 1 else b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        rows = part.collect()  # about `limit` bytes at most
        yield [r["i"] for r in rows], [r["t"] for r in rows]


def _verdict(n_words: str = "n_words", n_hit: str = "n_hit"):
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, item_ids
    (sorted as strings), contaminated (n_hit is not 0 and at least a twentieth
    of n_words)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"),
                      F.xxhash64(F.col(text)).alias("key"))
    outs = [_one_block(src, spark.sparkContext.broadcast(b), window)
            for b in _blocks(benchmark, item, item_text, block_bytes)]
    out = outs[0]
    if len(outs) > 1:
        # rows of equal id and text have equal results: they merge as one and
        # come back by a join
        merged = (union_all(outs).groupBy("key", "doc_id")
                  .agg(F.first("n_words").alias("n_words"),
                       F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"),
                       F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"))
                  .select("key", F.col("doc_id").alias("d"), "n_words",
                          F.size("hits").cast("long").alias("n_hit"), "item_ids"))
        rows = src.select("doc_id", "key")
        out = rows.join(merged, (rows.key == merged.key) & rows.doc_id.eqNullSafe(merged.d))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      "item_ids", _verdict().alias("contaminated"))


def _one_block(src: DataFrame, items, window: int) -> DataFrame:
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        test = TestSuffixes(*items.value, window)
        for batch in batches:
            for part in slices(batch, "text"):
                n_words, n_hit, wo, hits, found = test.judge(part.column("text"))
                at = np.searchsorted(hits, wo)
                local = hits - np.repeat(wo[:-1], n_hit)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("key"),
                    pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(local.astype(np.int64))),
                    pa.array([sorted({str(test.ids[i]) for i in x}) for x in found], pa.list_(pa.string()))],
                    names=["doc_id", "key", "n_words", "n_hit", "hits", "item_ids"])

    return src.mapInArrow(
        run, f"doc_id {kind}, key long, n_words long, n_hit long, hits array<long>, item_ids array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
            item: str = "item_id", item_text: str = "text", window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Longest verbatim matches of at least a window: doc_id, doc_at, n_words,
    item_id (as string), item_at, in words."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def one(items):
        def run(batches):
            test = TestSuffixes(*items.value, window)
            for batch in batches:
                for part in slices(batch, "text"):
                    m = test.places(part.column("text"))
                    ids = part.column("doc_id").take(pa.array([x[0] for x in m], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, *(pa.array([x[k] for x in m], pa.int64()) for k in (1, 2)),
                         pa.array([str(x[3]) for x in m], pa.string()), pa.array([x[4] for x in m], pa.int64())],
                        names=["doc_id", "doc_at", "n_words", "item_id", "item_at"])

        return src.mapInArrow(run, f"doc_id {kind}, doc_at long, n_words long, item_id string, item_at long")

    return union_all([one(spark.sparkContext.broadcast(b))
                      for b in _blocks(benchmark, item, item_text, block_bytes)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                      item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns. With
    one block the rows are filtered where they are; with several, the verdicts
    (id and text hash) are joined back."""
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        items = docs.sparkSession.sparkContext.broadcast(first)

        def run(batches):
            test = TestSuffixes(*items.value, window)
            for batch in batches:
                for part in slices(batch, text):
                    n_words, n_hit, *_ = test.judge(part.column(text))
                    yield part.filter(pa.array((n_hit == 0) | (n_hit * 20 < n_words)))

        return docs.mapInArrow(run, docs.schema)
    k, d = fresh(docs, "_key"), fresh(docs, "_doc")
    bad = (contamination(docs.withColumn(k, F.xxhash64(F.col(text))), benchmark, k, text, item, item_text,
                         window, block_bytes)
           .where("contaminated").select(F.col("doc_id").alias(d)).distinct())
    return docs.join(bad, F.xxhash64(F.col(text)) == F.col(d), "left_anti")
