"""Cross-tokenizer alignment by galloping intersection (operator 11).

A text is encoded by two vocabularies. The shorter list of token ends is
searched in the longer one: every end starts where its forerunner was found,
doubles its step until it is past its value and searches the last step by
halves. Many places of one slice of texts gallop side by side. Ends found in
both lists cut the tokens into groups; the differences of their ranks give the
tokens of either side in each group, and these are linked.

Links count corpus-wide by pairs of ids: how many documents hold a pair. The
most frequent pairs (at most `FREQUENT`) are broadcast as sorted arrays; all
others are joined by shuffle, where each pair has few rows. The best count of
an id is one number for each id of the first vocabulary.

Null and empty texts, and texts that one of the vocabularies doesn't give back
byte by byte, have no tokens. Rows that repeat an id or a text are documents of
their own. An empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored
from .kernels import ragged, slices
from .vocab import ByteVocab, PieceVocab, SliceIds, once

LANES = 8192
FREQUENT = 1 << 20
SLICE = 2 << 20
WIDE = 1 << 12
SHIFT = 16


def gallop(x: np.ndarray, ends: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """For ascending `x`, the first place in ascending `ends` that is not
    smaller; len(ends) where there is none. `x` is split into lanes that advance
    together."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    lanes = min(lanes, n)
    steps = -(-n // lanes)
    grid = np.ascontiguousarray(np.concatenate([x, np.full(lanes * steps - n, x[-1])]).reshape(lanes, steps).T)
    # place 0 is before all values, the last one after them
    line = np.concatenate([[-1], ends, [np.iinfo(np.int64).max]]).astype(np.int64)
    last = len(line) - 1
    out = np.empty((steps, lanes), np.int64)
    at = np.ones(lanes, np.int64)
    for j in range(steps):
        lane = np.flatnonzero(line[at] < grid[j])
        low, want, step = at[lane], grid[j][lane], 1
        while len(lane):
            high = np.minimum(low + step, last)
            past = line[high] < want
            there = ~past
            if there.any():
                at[lane[there]] = _halve(line, low[there], high[there], want[there])
            lane, low, want, step = lane[past], high[past], want[past], step * 2
        out[j] = at
    return out.T.ravel()[:n] - 1


def _halve(line: np.ndarray, low: np.ndarray, high: np.ndarray, want: np.ndarray) -> np.ndarray:
    """The first place after `low`, up to `high`, that is not smaller."""
    while (high - low > 1).any():
        mid = (low + high) >> 1
        under = line[mid] < want
        low, high = np.where(under, mid, low), np.where(under, high, np.maximum(mid, low + 1))
    return high


def common_ends(a: np.ndarray, b: np.ndarray, a_short: np.ndarray, b_short: np.ndarray):
    """Ranks (in a, in b) of the ends that both lists hold. The marks say of every
    end of a and b whether its text has no more ends in a than in b: there a's
    ends drive the search, else b's."""
    ia, ib = [], []
    for mark in (True, False):
        ra, rb = np.flatnonzero(a_short == mark), np.flatnonzero(b_short == mark)
        x, y = (a[ra], b[rb]) if mark else (b[rb], a[ra])
        place = gallop(x, y)
        hit = place < len(y)
        hit[hit] = y[place[hit]] == x[hit]
        found = np.flatnonzero(hit), place[hit]
        ia.append(ra[found[0] if mark else found[1]])
        ib.append(rb[found[1] if mark else found[0]])
    ia, ib = np.concatenate(ia), np.concatenate(ib)
    order = np.argsort(ia, kind="stable")
    return ia[order], ib[order]


class Aligned:
    """The alignment of one slice of texts: ids of all its tokens side by side,
    tokens of each text, and of each group the text, first tokens and sizes."""

    def __init__(self, texts: list, va: ByteVocab, vb: PieceVocab):
        x = SliceIds(texts, [va, vb])
        self.a, self.b = (i.astype(np.int64) for i in x.ids)
        self.n = n = x.n
        # every text's last ends are common, so ends may run on over all texts
        ends = np.cumsum(va.size[self.a]), np.cumsum(vb.size[self.b])
        short = n[0] <= n[1]
        ia, ib = common_ends(*ends, np.repeat(short, n[0]), np.repeat(short, n[1]))
        before = (lambda x: np.concatenate([[-1], x[:-1]]) if len(x) else x)
        self.at = before(ia) + 1, before(ib) + 1
        self.size = ia + 1 - self.at[0], ib + 1 - self.at[1]
        self.text = np.searchsorted(np.cumsum(n[0]), self.at[0], "right")
        k = len(texts)
        self.n_groups = np.bincount(self.text, minlength=k)
        self.n_links = np.zeros(k, np.int64)
        np.add.at(self.n_links, self.text, self.size[0] * self.size[1])

    def groups(self) -> pa.Array:
        """Of each text: its groups as a1,a2|b1;a3|b2,b3."""
        na, nb = self.size
        out_at = np.cumsum(na + nb) - na - nb
        total = int((na + nb).sum())
        ids, mark = np.empty(total, np.int64), np.zeros(total, np.int64)
        ids[ragged(out_at, na)] = self.a
        ids[ragged(out_at + na, nb)] = self.b
        mark[out_at + na - 1] = 1
        mark[out_at + na + nb - 1] = 2
        stop = np.cumsum(self.n.sum(0))
        mark[stop[self.n[0] > 0] - 1] = 3
        written, size = once("written ids", _written)
        cells = written[mark, ids].view(np.uint8)
        off = np.concatenate([[0], np.cumsum(size[mark, ids])])[np.concatenate([[0], stop])]
        return pa.LargeStringArray.from_buffers(len(stop), pa.py_buffer(off.astype(np.int64)),
                                                pa.py_buffer(cells[cells != 0])).cast(pa.string())

    def pairs(self):
        """(text, pair, links): pairs of ids linked in a text, ascending by text
        and pair, and how many links each has. A pair is a << 16 | b."""
        (na, nb), (pa_, pb) = self.size, self.at
        wide = na * nb > WIDE
        keys, counts = [], []
        g = np.flatnonzero(~wide)
        k = na[g] * nb[g]
        inside = ragged(np.zeros(len(g), np.int64), k)
        g = np.repeat(g, k)
        key = (self.text[g] << 2 * SHIFT) | (self.a[pa_[g] + inside // nb[g]] << SHIFT) | self.b[pb[g] + inside % nb[g]]
        keys.append(key)
        counts.append(np.ones(len(key), np.int64))
        for i in np.flatnonzero(wide).tolist():  # many tokens, of fewer different ids
            a, ca = np.unique(self.a[pa_[i]:pa_[i] + na[i]], return_counts=True)
            b, cb = np.unique(self.b[pb[i]:pb[i] + nb[i]], return_counts=True)
            keys.append(((self.text[i] << 2 * SHIFT) | (a[:, None] << SHIFT) | b).ravel())
            counts.append((ca[:, None] * cb).ravel())
        if len(keys) == 1:
            key, n = np.unique(keys[0], return_counts=True)
        else:
            key, inv = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, inv, np.concatenate(counts))
        return key >> 2 * SHIFT, key & ((1 << 2 * SHIFT) - 1), n


def _written():
    """Every id as text, followed by a comma, a bar, a semicolon or nothing, and
    the lengths."""
    text = np.array([[b"%d%s" % (i, c) for i in range(1 << SHIFT)] for c in (b",", b"|", b";", b"")])
    return text, np.char.str_len(text)


def align(docs: DataFrame, byte_vocab: str, piece_vocab: str, text: str = "text") -> DataFrame:
    """The rows of docs without `text`, with n_a, n_b, n_groups, n_links, groups
    (as a1,a2|b1;a3|b2,b3), pairs (different linked id pairs, a << 16 | b) and
    links (how many links each pair has). Columns of docs that have these names
    are replaced. Nothing is shuffled. The vocabularies are files that every
    machine has at these places."""
    own = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]
    t = fresh(docs, "_t")
    carry = [c for c in docs.columns if c != text and c not in own]
    src = docs.select(*carry, F.col(text).alias(t))

    def run(batches):
        vocabs = ByteVocab.of(byte_vocab), PieceVocab.of(piece_vocab)
        for batch in batches:
            for part in slices(batch, t, SLICE):
                x = Aligned(part.column(t).to_pylist(), *vocabs)
                row, pair, n = x.pairs()
                off = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(x.n[0]), pa.array(x.n[1]), pa.array(x.n_groups), pa.array(x.n_links),
                     x.groups(),
                     pa.ListArray.from_arrays(off, pa.array(pair)),
                     pa.ListArray.from_arrays(off, pa.array(n))], names=[*carry, *own])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != t]
                       + [f"{c} long" for c in own[:4]] + ["groups string, pairs array<long>, links array<long>"])
    return src.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): in how many rows each pair of ids is linked."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _frequent_from(counts: DataFrame, most: int) -> int:
    """The smallest count such that at most `most` pairs have it or more, in
    steps of an eighth of a power of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    above = 0
    for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("top")).orderBy(
            F.desc("s")).collect():
        above += r["k"]
        if above > most:
            return r["top"] + 1
    return 0


def link_scores(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows of `aligned` without groups, pairs and links, with n_best (links
    whose count is the highest of their first id) and count_sum (over links).
    Pass a stored table: it is read three times."""
    spark = aligned.sparkSession
    counts = stored(pair_counts(aligned), "pairs")
    best = dict(map(tuple, counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n")).collect()))
    least = _frequent_from(counts, frequent)
    known = counts.where(F.col("n") >= least).orderBy("pair").toPandas()
    top = np.zeros(1 << SHIFT, np.int64)
    top[list(best)] = list(best.values())
    state = spark.sparkContext.broadcast((known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64), top))
    carry = [c for c in aligned.columns if c not in ("groups", "pairs", "links", "n_best", "count_sum")]
    row = fresh(aligned, "_row")
    src = aligned.select(*carry, "pairs", "links")

    def look_up(batches):
        pairs, n, top = state.value
        for batch in batches:
            p, w = batch.column("pairs"), batch.column("links")
            off = p.offsets.to_numpy().astype(np.int64)
            key = p.values.to_numpy()[off[0]:off[-1]]
            w = w.values.to_numpy()[w.offsets[0].as_py():w.offsets[-1].as_py()]
            off = off - off[0]
            at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            seen = pairs[at] == key if len(pairs) else np.zeros(len(key), bool)
            c = np.where(seen, n[at], 0) if len(pairs) else np.zeros(len(key), np.int64)
            total = (lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off]))
            rare = np.flatnonzero(~seen)
            rare_off = pa.array(np.searchsorted(rare, off).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in carry),
                 pa.array(total(np.where(seen & (c == top[key >> SHIFT]), w, 0))), pa.array(total(c * w)),
                 pa.ListArray.from_arrays(rare_off, pa.array(key[rare])),
                 pa.ListArray.from_arrays(rare_off, pa.array(w[rare]))],
                names=[*carry, "n_best", "count_sum", "rare", "w"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name in carry]
                       + ["n_best long, count_sum long, rare array<long>, w array<long>"])
    part = src.mapInArrow(look_up, schema).withColumn(row, F.monotonically_increasing_id())
    part = stored(part, "frequent")
    rest = counts.where(F.col("n") < least).select(
        "pair", "n", F.shiftright("pair", SHIFT).alias("a"))
    # the best counts of ids that have rare pairs, one row an id
    tops = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("top"))
    open_ = part.where(F.size("rare") > 0).select(row, F.explode(F.arrays_zip("rare", "w")).alias("x"))
    more = (open_.select(row, F.col("x.rare").alias("pair"), F.col("x.w").alias("w")).join(rest, "pair").join(tops, "a")
            .groupBy(F.col(row).alias("r")).agg(
                F.sum(F.when(F.col("n") == F.col("top"), F.col("w")).otherwise(0)).alias("more_best"),
                F.sum(F.col("n") * F.col("w")).alias("more_sum")))
    return part.join(more, part[row] == more["r"], "left").select(
        *carry, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))

