"""Substring dedup by suffix arrays (operator 8).

Every byte covered by a string of 200 bytes that also starts anywhere else in
the corpus, in the same document too, is removed. `repeats` finds the runs of
text that can hold such strings; equal runs are settled there. The runs that
share a gram but differ (the edges of repeated passages) are laid side by
side, gram by gram, in blocks of bounded size: two-stage sorting builds each
block's suffix array, and neighbours with a common prefix of 200 bytes are
repeats. A gram with very many different runs would overfill a block; its
200-byte strings are counted by their 128-bit hash instead, one row a string.

Null text is empty. Rows that repeat a text repeat all of it. Texts are bytes
(UTF-8); what remains may not be valid UTF-8 and is binary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tasks_for
from .kernels import BYTE, Texts, ragged, run_hash, signed, slices
from .repeats import byte_runs, repeated_runs, structs, text_tag, with_text
from .suffix_sort import long_repeats

SIZE = 200
CROWD = 2048
BLOCK_BYTES = 1 << 20


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE,
                    crowd: int = CROWD) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, spans (array of at,
    n: maximal removed runs), kept (remaining bytes). size: at least 32."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.xxhash64(F.col(text)).alias("d"), text_tag(text).alias("th"),
                      F.col(text).alias("text"))
    runs = repeated_runs(src.select("d", "th", "text").where("text is not null"), byte_runs(size), size,
                         ordered=False)
    texts = src.repartition(tasks_for(docs), "d", "th")
    # one row a piece, or one a string where a gram has a crowd of runs
    cut = stored(with_text(texts, runs.where("check"), ["key", "at", "n", "n_ctx"]).mapInArrow(_cut(size, crowd), CUT),
                 "pieces")
    pieces = (cut.where("piece is not null").select("key", "d", "th", "at", "piece")
              .repartition(tasks_for(docs), "key").sortWithinPartitions("key"))
    found = pieces.mapInArrow(_sort(size), "d long, th int, at int, n int")
    strings = cut.where("piece is null")
    often = strings.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key", "key2")
    single = strings.join(often, ["key", "key2"]).select("d", "th", "at", F.lit(1).alias("n"))
    hits = runs.where("hit").select("d", "th", "at", "n").unionByName(found).unionByName(single)
    per = hits.groupBy("d", "th").agg(F.collect_set(F.struct("at", "n")).alias("rows"))
    return texts.join(per, ["d", "th"], "left").mapInArrow(
        _rest(size), "doc_id long, n_bytes long, n_removed long, spans array<struct<at: long, n: long>>, kept binary")


CUT = "key long, key2 long, d long, th int, at int, piece binary"


def _cut(size: int, crowd: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                row, f = structs(part)
                t = Texts(part.column("text"))
                key, at, n = (f[k].to_numpy().astype(np.int64) for k in ("key", "at", "n"))
                d, th = (part.column(k).to_numpy() for k in ("d", "th"))
                many = f["n_ctx"].to_numpy() > crowd
                # pieces overlap: batches of bounded output
                i = np.flatnonzero(~many)
                length = n[i] + size - 1
                group = np.cumsum(length) // (4 << 20)
                for k in np.unique(group):
                    j, w = i[group == k], length[group == k]
                    off = np.concatenate([[0], np.cumsum(w)]).astype(np.int32)
                    data = t.data[ragged(t.off[row[j]] + at[j], w)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[j]), pa.nulls(len(j), pa.int64()), pa.array(d[row[j]]), pa.array(th[row[j]]),
                         pa.array(at[j].astype(np.int32)),
                         pa.BinaryArray.from_buffers(pa.binary(), len(j), [None, pa.py_buffer(off), pa.py_buffer(data)])],
                        names=["key", "key2", "d", "th", "at", "piece"])
                j = np.flatnonzero(many)
                if not len(j):
                    continue
                r, w = np.repeat(row[j], n[j]), ragged(at[j], n[j])
                a = t.off[r] + w
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(run_hash(BYTE[t.data], a, a + size))),
                     pa.array(signed(run_hash(BYTE[255 - t.data], a, a + size))), pa.array(d[r]), pa.array(th[r]),
                     pa.array(w.astype(np.int32)), pa.nulls(len(r), pa.binary())],
                    names=["key", "key2", "d", "th", "at", "piece"])

    return run


def _sort(size: int):
    def run(batches):
        """Blocks of whole key groups; the last, open group is carried on (it
        has a bounded number of pieces)."""
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in slices(batch, "piece", BLOCK_BYTES):
                held = pa.concat_batches([held, part]) if held is not None else part
                key = np.asarray(held.column("key"))
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield _block(held.slice(0, cut), size)
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield _block(held, size)

    return run


def _block(part: pa.RecordBatch, size: int) -> pa.RecordBatch:
    t = Texts(part.column("piece"))
    length = np.diff(t.off)
    # one string end after each piece
    first = t.off[:-1] + np.arange(t.n)
    sym = np.zeros(len(t.data) + t.n, np.int16)
    sym[ragged(first, length)] = t.data.astype(np.int16) + 1
    left = np.repeat(first + length, length + 1) - np.arange(len(sym))
    hit = long_repeats(sym, left, size)
    i = np.flatnonzero(hit)
    new = np.ones(len(i), bool)
    new[1:] = i[1:] != i[:-1] + 1
    a = i[new]
    n = np.diff(np.append(np.flatnonzero(new), len(i)))
    row = np.searchsorted(first, a, "right") - 1
    at = np.asarray(part.column("at")).astype(np.int64)[row] + a - first[row]
    return pa.RecordBatch.from_arrays(
        [part.column("d").take(pa.array(row)), part.column("th").take(pa.array(row)),
         pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["d", "th", "at", "n"])


def _rest(size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                t = Texts(part.column("text"))
                row, f = structs(part)
                at = t.off[row] + np.asarray(f["at"]).astype(np.int64)
                cover = np.zeros(len(t.data) + 1, np.int32)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + np.asarray(f["n"]) + size - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = np.concatenate([[0], np.cumsum(~gone)])[t.off]
                start = gone.copy()
                start[1:] &= ~gone[:-1]
                own = t.off[:-1][np.diff(t.off) > 0]
                start[own] = gone[own]
                a = np.flatnonzero(start)
                stop = gone.copy()
                stop[:-1] &= ~gone[1:]
                stop[t.off[1:][np.diff(t.off) > 0] - 1] = gone[t.off[1:][np.diff(t.off) > 0] - 1]
                n = np.flatnonzero(stop) + 1 - a
                per = np.searchsorted(a, t.off)
                base = np.repeat(t.off[:-1], np.diff(per))
                spans = pa.ListArray.from_arrays(
                    pa.array(per.astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(a - base), pa.array(n)], names=["at", "n"]))
                size_of = np.diff(t.off)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size_of), pa.array(size_of - np.diff(kept)), spans,
                     pa.BinaryArray.from_buffers(pa.binary(), t.n, [None, pa.py_buffer(kept.astype(np.int32)),
                                                                    pa.py_buffer(t.data[~gone])])],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return run
