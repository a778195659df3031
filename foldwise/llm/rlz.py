"""Substring dedup by relative Lempel-Ziv parsing (operator 2).

A document is factored against all documents with smaller ids. The reference
is indexed in blocks: every block holds the runs of text (see `repeats`) whose
gram hashes into it, with the first document that has each run. A run of a
document that stands whole in a smaller document is part of a factor;
consecutive windows with the same reference document are one factor, as long
as it goes. Where the surrounding text differs, at factor boundaries, every
window is looked up by itself, because a window that straddles a boundary may
stand in another reference.

Words are `[^\\x20\\x09-\\x0D]+`. A null text has no words and the empty text as
its remainder. Rows with a null id are returned whole and are no reference.
Rows that repeat an id are judged one by one; none of them is "smaller" than
another. Ids are integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tasks_for
from .kernels import SPACE, Texts, gram_hash, ragged, signed, slices
from .repeats import repeated_runs, structs, text_tag, with_text, word_runs

WINDOW = 13


def factor(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, factors (array of
    at, n, ref: n words from word `at` stand in document `ref`), kept (the words
    outside all factors, joined by one space)."""
    src = docs.select(F.col(id_col).cast("long").alias("d"), text_tag(text).alias("th"),
                      F.col(text).alias("text"))
    runs = repeated_runs(src.where("d is not null and text is not null"), word_runs(window), window, ordered=True)
    n = tasks_for(docs)
    texts = src.repartition(n, "d", "th")

    def windows(batches):
        """Every window of the runs to be checked."""
        for batch in batches:
            for part in slices(batch, "text"):
                row, f = structs(part)
                t = Texts(part.column("text"))
                starts, ends, wo = t.words(SPACE)
                g = gram_hash(t.word_hash(starts, ends), window)
                size = np.asarray(f["n"]).astype(np.int64)
                at = ragged(np.asarray(f["at"]).astype(np.int64), size)
                r = np.repeat(row, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(g[wo[r] + at])), pa.array(np.asarray(part.column("d"))[r]),
                     pa.array(np.asarray(part.column("th"))[r]), pa.array(at.astype(np.int32))],
                    names=["h", "d", "th", "at"])

    single = with_text(texts, runs.where("check"), ["at", "n"]).mapInArrow(
        windows, "h long, d long, th int, at int")
    single = (single.withColumn("ref", F.min("d").over(Window.partitionBy("h"))).where("d > ref")
              .select("d", "th", "at", F.lit(1).alias("n"), "ref"))
    hits = runs.where("hit").select("d", "th", "at", "n", "ref").unionByName(single)
    per = hits.groupBy("d", "th").agg(F.collect_set(F.struct("at", "n", "ref")).alias("rows"))

    def parse(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _parse(part, window)

    return texts.join(per, ["d", "th"], "left").mapInArrow(
        parse, "doc_id long, n_words long, n_removed long, "
               "factors array<struct<at: long, n: long, ref: long>>, kept string")


def _parse(part: pa.RecordBatch, window: int) -> pa.RecordBatch:
    t = Texts(part.column("text"))
    starts, ends, wo = t.words(SPACE)
    row, f = structs(part)
    at, n, ref = (np.asarray(f[k]).astype(np.int64) for k in ("at", "n", "ref"))
    order = np.lexsort((at, row))
    row, at, n, ref = row[order], at[order], n[order], ref[order]
    # greedy: a factor goes on while the next windows follow in the same reference
    new = np.ones(len(row), bool)
    if len(row) > 1:
        new[1:] = (row[1:] != row[:-1]) | (ref[1:] != ref[:-1]) | (at[1:] != at[:-1] + n[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(row) else first
    f_row, f_at, f_ref = row[first], at[first], ref[first]
    f_n = at[last] + n[last] - f_at + window - 1
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, wo[f_row] + f_at, 1)
    np.add.at(cover, wo[f_row] + f_at + f_n, -1)
    keep = np.cumsum(cover[:-1]) == 0
    kept_off, text = joined(t.data, starts[keep], ends[keep], np.searchsorted(np.flatnonzero(keep), wo))
    n_words = np.diff(wo)
    gone = n_words - np.diff(np.searchsorted(np.flatnonzero(keep), wo))
    per = np.searchsorted(f_row, np.arange(t.n + 1))
    factors = pa.ListArray.from_arrays(
        pa.array(per.astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(f_at), pa.array(f_n), pa.array(f_ref)], names=["at", "n", "ref"]))
    return pa.RecordBatch.from_arrays(
        [part.column("d"), pa.array(n_words.astype(np.int64)), pa.array(gone.astype(np.int64)), factors,
         pa.StringArray.from_buffers(t.n, pa.py_buffer(kept_off.astype(np.int32)), pa.py_buffer(text))],
        names=["doc_id", "n_words", "n_removed", "factors", "kept"])


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
    """Words of each row joined by one space: (offsets, bytes)."""
    size = ends - starts
    last = np.zeros(len(size), bool)
    full = bounds[1:] > bounds[:-1]
    last[bounds[1:][full] - 1] = True
    width = size + ~last
    to = np.concatenate([[0], np.cumsum(width)])
    out = np.full(int(to[-1]), 0x20, np.uint8)
    out[ragged(to[:-1], size)] = data[ragged(starts, size)]
    return to[bounds], out
