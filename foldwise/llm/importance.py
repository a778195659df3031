"""Target-distribution importance resampling (operator 12).

Words and pairs of neighbouring words are hashed into buckets. Every task
counts its own texts into one array of buckets; the arrays of the corpus and of
the target are added up, and a bucket's gain is a thousand times the log ratio
of its smoothed shares. The gains are an array of fixed length (`buckets`),
broadcast, in which the tasks look up the weight of each text.

The draw adds Gumbel noise from a hash of the id and takes the k highest
scores by distributed quickselect over a composite key that no two rows share:
score, id, hash of the text, row number. Every round counts the rows before,
on and between some random pivots exactly and draws the next pivots from every
gap, in the same aggregate; the gap that holds the k-th key is searched on. No
row reaches the driver but pivots and counts. Only the winners are sorted.

Null and empty texts have no words, weight 0 and no rank. A null id draws like
the empty id and comes last among ties. Rows that repeat an id are rows of their
own with the same noise. An empty corpus gives an empty result; an empty target
gives gains from its smoothing alone. Long texts are read word by word from
their bytes, in pieces."""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import global_index
from .common import fresh, stored
from .kernels import LOWER, NON_ALNUM, slices

BUCKETS = 10_000
SEED = 7
SHARE = 25
MIN_WORDS = 20
PIVOTS = 16
PIECE = 1 << 20
_SPACED = bytes(0x20 if NON_ALNUM[c] else int(c) for c in LOWER.tolist())


def _hashes(text: str | None, piece: int):
    """crc32 of the words of a text, then of its word pairs, a piece at a time:
    lists (words, pairs). A pair's hash goes on from its first word's."""
    raw = (text or "").encode().translate(_SPACED)
    at, last = 0, None
    while at < len(raw):
        stop = at + piece
        if stop < len(raw):  # end between words
            cut = raw.rfind(b" ", at, stop)
            stop = cut if cut > at else raw.find(b" ", stop)
            stop = stop if stop >= 0 else len(raw)
        words = raw[at:stop].split()
        at = max(stop, at + 1)
        if not words:
            continue
        one = list(map(crc32, words))
        before = one[:-1] if last is None else [last, *one[:-1]]
        two = list(map(crc32, [b" " + w for w in (words[1:] if last is None else words)], before))
        last = one[-1]
        yield one, two


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, piece: int = PIECE) -> DataFrame:
    """(bucket, n): features of all texts by bucket; every task sends one row a
    bucket at most."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                for one, two in _hashes(t.as_py(), piece):
                    total += np.bincount(np.array(one + two, np.int64) % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    part = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
          buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket; `buckets` numbers come to the driver."""

    def counts(df, col):
        out = [0] * buckets
        for r in bucket_counts(df, col, buckets).collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = counts(docs, text), counts(target, target_text)
    over, under = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((b + 1.0) * over / ((a + 1.0) * under))) for a, b in zip(s, t)]


def weigh(docs: DataFrame, gain: list[int], text: str = "text", piece: int = PIECE, n_words: str = "n_words",
          n_features: str = "n_features", weight: str = "weight") -> DataFrame:
    """The rows of docs with n_words, n_features and weight (floored mean gain)."""
    table, size = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.int64)), len(gain)

    def run(batches):
        gain = table.value
        for batch in batches:
            for part in slices(batch, text):
                out = np.zeros((3, part.num_rows), np.int64)
                for i, t in enumerate(part.column(text)):
                    words = pairs = total = 0
                    for one, two in _hashes(t.as_py(), piece):
                        words, pairs = words + len(one), pairs + len(two)
                        total += int(gain[np.array(one + two, np.int64) % size].sum())
                    out[:, i] = words, words + pairs, total // (words + pairs) if words else 0
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, out)],
                                                 names=[*part.schema.names, n_words, n_features, weight])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
                       + [f"`{c}` long" for c in (n_words, n_features, weight)])
    return docs.mapInArrow(run, schema)


def noise(id_col: str, seed: int = SEED) -> Column:
    """floor(1000 times Gumbel noise) from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def kth(keys: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th smallest (from 1) of the keys, a struct column `key` of which no
    two rows are equal; None beyond their number.

    The pivots of a round cut the rows into gaps; one aggregate gives each gap's
    exact count and, by random hashes, the next pivots in it."""
    low = high = None  # the k-th key lies between, both left out
    cuts: list = []
    skipped, seed = 0, 0
    kind = keys.schema["key"].dataType

    def lit(row):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind)])

    while True:
        live = keys
        if low is not None:
            live = live.where(F.col("key") > lit(low))
        if high is not None:
            live = live.where(F.col("key") < lit(high))
        # rows equal to the i-th cut are in part 2i + 1, rows between cuts in even parts
        part = F.lit(0)
        for c in cuts:
            part = part + (F.col("key") >= lit(c)).cast("int") + (F.col("key") > lit(c)).cast("int")
        draws = [F.min_by("key", F.xxhash64("key", F.lit(seed + i))).alias(f"p{i}") for i in range(pivots)]
        got = live.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), *draws).orderBy("part").collect()
        seed += pivots
        for r in got:
            if skipped + r["n"] >= k:
                break
            skipped += r["n"]
        else:
            return None
        if r["part"] % 2:
            return cuts[r["part"] // 2]
        i = r["part"] // 2
        low, high = (cuts[i - 1] if i else low), (cuts[i] if i < len(cuts) else high)
        cuts = sorted({tuple(r[f"p{j}"]) for j in range(pivots)})
        if r["n"] == 1:
            return cuts[0]


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text",
             target_text: str = "text", share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
             carry: list[str] | None = None, buckets: int = BUCKETS, pivots: int = PIVOTS) -> DataFrame:
    """The rows of docs (columns `carry`, all by default) with n_features,
    weight, score and rank: 1, 2, 3... for the `share` percent of the texts with
    at least `min_words` words that were drawn, else null. Columns of docs that
    have these names are replaced."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("n_features", "weight", "score", "rank")]
    wide = docs.select(*dict.fromkeys([*carry, id_col, text]))
    names = {c: fresh(wide, c) for c in ("n_words", "n_features", "weight")}
    w = weigh(wide, gains(docs, target, text, target_text, buckets), text, **names)
    back = F.negate(F.col(names["weight"]) + noise(id_col, seed))
    # the smallest keys are drawn; null ids come last
    key = F.struct(back.alias("s"), F.col(id_col).isNull().alias("z"), F.col(id_col).alias("i"),
                   F.xxhash64(text).alias("t"), F.monotonically_increasing_id().alias("r"))
    scored = stored(w.select(F.struct(*carry).alias("d"), F.col(names["n_words"]).alias("w"),
                             F.col(names["n_features"]).alias("f"), F.col(names["weight"]).alias("g"),
                             key.alias("key")), "scored")
    fit = F.col("w") >= min_words
    n = scored.where(fit).count() * share // 100
    last = kth(scored.where(fit).select("key"), n, pivots) if n else None
    out = [F.col(f"d.{c}") for c in carry]
    out += [F.col("f").alias("n_features"), F.col("g").alias("weight"), F.negate(F.col("key.s")).alias("score")]
    if last is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    edge = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(last, scored.schema["key"].dataType)])
    won = fit & (F.col("key") <= edge)
    ranked = global_index(scored.where(won), ["key"], "rank").select(*out, (F.col("rank") + 1).alias("rank"))
    return ranked.union(scored.where(~won).select(*out, F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of docs that are drawn, with their score and rank."""
    return resample(docs, target, **options).where(F.col("rank").isNotNull())

