"""Search for windows (13 words, 200 bytes, ...) that occur more than once in a
corpus, without shuffling every window. Shared by the substring operators.

Every window picks the smallest hash of the short grams inside it; equal
windows pick equal grams at equal places. Consecutive windows with the same
pick form a run, and only runs are shuffled, by their gram:

* runs with equal gram and equal text are settled at once: all their windows
  are repeated;
* runs with equal gram and different text (the edges of repeated passages)
  are left for the operator to compare window by window or suffix by suffix;
* a gram that occurs once settles all windows of its run: none is repeated.

Before the shuffle a task merges equal runs inside each slice of text, so a
passage that a third of all documents hold sends one row a slice, not one a
document."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tasks_for
from .kernels import (BYTE, SPACE, Texts, byte_gram32, gram_hash, mix, run_hash, signed, slices, window_min_at,
                      within_rows)

RUN = "key long, ctx long, d long, place long"
# place: first window 31 bits, text hash 20, windows 11, settled 1, repeated 1
TH_BITS, N_BITS = 20, 11


def text_tag(text) -> Column:
    """Tells texts of rows with equal `d` apart."""
    return F.pmod(F.hash(text), F.lit(1 << TH_BITS)).cast("int")


def word_runs(size: int, gram: int = 4) -> Callable:
    def runs(t: Texts):
        starts, ends, bounds = t.words(SPACE)
        h = t.word_hash(starts, ends)
        g = gram_hash(h, gram)
        return h, g, window_min_at(g, size - gram + 1), bounds

    return runs


def byte_runs(size: int) -> Callable:
    def runs(t: Texts):
        g = byte_gram32(t)
        return BYTE[t.data], g, window_min_at(g, size - 31), t.off

    return runs


def _rows(part: pa.RecordBatch, kernel: Callable, size: int, ordered: bool):
    """Runs of a slice, merged where they are equal. ordered: a run is repeated
    only if a smaller document has it; else if it occurs anywhere else."""
    t = Texts(part.column("text"))
    h, g, p, bounds = kernel(t)
    i = np.flatnonzero(within_rows(bounds, size, len(p)))
    if not len(i):
        return None
    q = p[i]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1] + 1) | (q[1:] != q[:-1])
    f = np.flatnonzero(new)
    a, n = i[f], np.diff(np.append(f, len(i)))
    key, ctx = g[q[f]], run_hash(h, a, a + n + size - 1)
    row = np.searchsorted(bounds, a, "right") - 1
    at = a - bounds[row]
    d = np.asarray(part.column("d"))[row]
    th = np.asarray(part.column("th"))[row]
    # merge equal runs of the slice
    order = np.lexsort((at, d, key, ctx))
    k, c, dd, aa = key[order], ctx[order], d[order], at[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    f = np.flatnonzero(first)
    count = np.diff(np.append(f, len(k)))
    low = np.repeat(dd[f], count)
    keep = np.ones(len(k), bool)
    if ordered:
        settled = dd > low
        again = np.zeros(len(k), bool)
    else:
        settled = ~first
        again = np.repeat(count > 1, count)
        keep[1:] = first[1:] | (dd[1:] != dd[:-1]) | (aa[1:] != aa[:-1])  # copies of a text: one row
    # settled rows travel alone, with the reference in place of the text
    lone = mix(k ^ (c * np.uint64(3)) ^ np.arange(len(k), dtype=np.uint64))
    k = np.where(settled, lone, k)
    c = np.where(settled, low, signed(c))
    place = ((aa.astype(np.uint64) << np.uint64(33)) | (th[order].astype(np.uint64) << np.uint64(13))
             | (n[order].astype(np.uint64) << np.uint64(2)) | (settled.astype(np.uint64) << np.uint64(1))
             | again.astype(np.uint64))
    back = np.argsort(order, kind="stable")  # document order compresses best
    back = back[keep[back]]
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(k)[back]), pa.array(c[back]), pa.array(dd[back]), pa.array(signed(place)[back])],
        names=["key", "ctx", "d", "place"])


def repeated_runs(src: DataFrame, kernel: Callable, size: int, ordered: bool) -> DataFrame:
    """Runs that are repeated (`hit`) or have to be looked at (`check`), from
    `src` (d long, th: `text_tag`, text): d, th, at, n (windows), ref, hit,
    check, key, n_ctx (different runs with this gram). Written to the shared
    folder."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                out = _rows(part, kernel, size, ordered)
                if out is not None:
                    yield out

    runs = src.mapInArrow(run, RUN)
    runs = (runs.repartition(tasks_for(runs), "key")
            .withColumn("settled", F.col("place").bitwiseAND(2) > 0))
    one = Window.partitionBy("key", "ctx").orderBy("d", "place")
    text = Window.partitionBy("key", "ctx")
    gram = Window.partitionBy("key")
    r = (runs.withColumn("rn", F.row_number().over(one)).withColumn("low", F.min("d").over(text))
         .withColumn("n_ctx", F.sum((F.col("rn") == 1).cast("int")).over(gram)))
    if ordered:
        hit = F.col("settled") | (F.col("d") > F.col("low"))
        check = ~F.col("settled") & (F.col("d") == F.col("low")) & (F.col("n_ctx") > 1)
    else:
        r = r.withColumn("total", F.max(F.col("place").bitwiseAND(1) + F.col("rn")).over(text))
        hit = F.col("settled") | (F.col("total") > 1)
        check = ~F.col("settled") & (F.col("rn") == 1) & (F.col("n_ctx") > 1)
    r = (r.withColumn("hit", hit).withColumn("check", check).where("hit or check")
         .select("key", "d", F.shiftrightunsigned("place", 33).cast("int").alias("at"),
                 F.shiftright("place", 13).bitwiseAND((1 << TH_BITS) - 1).cast("int").alias("th"),
                 F.shiftright("place", 2).bitwiseAND((1 << N_BITS) - 1).cast("int").alias("n"),
                 "hit", "check", "n_ctx",
                 F.when(F.col("settled"), F.col("ctx")).otherwise(F.col("low")).alias("ref")))
    return stored(r, "runs")


def with_text(texts: DataFrame, rows: DataFrame, what: list[str]) -> DataFrame:
    """Join rows, gathered by text (d, th), to `texts` (d, th, text)."""
    per = rows.groupBy("d", "th").agg(F.collect_set(F.struct(*what)).alias("rows"))
    return texts.join(per, ["d", "th"])


def structs(part: pa.RecordBatch, column: str = "rows"):
    """A list-of-struct column of a slice, flat: (row of the slice, fields)."""
    col = part.column(column)
    off = np.asarray(col.offsets).astype(np.int64)
    flat = col.values.slice(off[0], off[-1] - off[0]) if len(off) else col.values
    size = np.diff(off)
    if col.null_count:
        size = np.where(np.asarray(col.is_null()), 0, size)
    row = np.repeat(np.arange(len(col)), size)
    return row, {f.name: flat.field(k) for k, f in enumerate(flat.type)}
