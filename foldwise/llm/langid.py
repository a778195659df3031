"""Language identification by a byte convolutional network (operator 7).

Texts are cut into windows of `LENGTH` bytes, all of them, the last one padded.
Filters of several widths slide over byte embeddings; each filter keeps its
largest value in the window, and a softmax layer gives the window's languages.
A document's scores are the softmax of its windows' mean logits, weighted by
their bytes.

The network is trained in numpy, on the driver, on windows of at most
`max_docs` labelled documents (those with the smallest hash of id and text;
at most `PER_DOC` evenly spaced windows of each), a documented bound. For
prediction the filters are folded into tables of byte pairs, so a window's
convolution is a few gathers and additions.

`und` with score 0 for a null text, one without any letter, or when nothing
was there to learn from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import Texts, ragged, slices

LENGTH = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
MAX_DOCS = 4000
PER_DOC = 4
STEPS = 1500
BATCH = 64
UND = "und"


def cut_windows(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a slice: (bytes, row, number of bytes)."""
    size = np.diff(t.off)
    n = -(-size // LENGTH)
    row = np.repeat(np.arange(t.n), n)
    k = ragged(np.zeros(t.n, np.int64), n)
    start = t.off[row] + k * LENGTH
    real = np.minimum(size[row] - k * LENGTH, LENGTH)
    pad = np.concatenate([t.data, np.zeros(LENGTH, np.uint8)])
    w = np.lib.stride_tricks.sliding_window_view(pad, LENGTH)[start].copy()
    w[np.arange(LENGTH) >= real[:, None]] = 0
    return w, row, real


class Network:
    """Embedding, filters of each width, softmax layer."""

    def __init__(self, langs: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs = langs
        c = len(langs)
        p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), c)),
             "bias": np.zeros(c)}
        for w in WIDTHS:
            p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS))
            p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def _forward(self, x: np.ndarray):
        p, n = self.p, len(x)
        span = LENGTH - max(WIDTHS) + 1
        e = p["emb"][x]
        feats, keep = [], []
        for w in WIDTHS:
            patch = np.concatenate([e[:, j:span + j] for j in range(w)], axis=2)
            z = patch.reshape(-1, w * EMBED) @ p[f"f{w}"]
            z = z.reshape(n, span, FILTERS)
            at = z.argmax(1)
            best = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + p[f"b{w}"]
            feats.append(np.maximum(best, 0))
            keep.append((patch, at, best > 0))
        h = np.concatenate(feats, 1)
        return h, keep, h @ p["out"] + p["bias"]

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            i = rng.integers(0, len(x), BATCH)
            h, keep, z = self._forward(x[i])
            q = np.exp(z - z.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            q[np.arange(BATCH), y[i]] -= 1
            q /= BATCH
            g = {"out": h.T @ q, "bias": q.sum(0), "emb": np.zeros_like(self.p["emb"])}
            dh = q @ self.p["out"].T
            for k, w in enumerate(WIDTHS):
                patch, at, on = keep[k]
                d = dh[:, k * FILTERS:(k + 1) * FILTERS] * on
                best = np.take_along_axis(patch[:, :, None, :], at[:, None, :, None], 1)[:, 0]
                g[f"f{w}"] = np.einsum("bf,bfe->ef", d, best)
                g[f"b{w}"] = d.sum(0)
                de = (d[:, :, None] * self.p[f"f{w}"].T[None]).reshape(BATCH, FILTERS, w, EMBED)
                for j in range(w):
                    np.add.at(g["emb"], x[i][np.arange(BATCH)[:, None], at + j], de[:, :, j])
            rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                              / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def tables(self):
        """Filter responses by byte pair: the first two bytes of every width,
        the third byte of width 3, the last two of width 4."""
        p = self.p
        part = (lambda w, j: p["emb"] @ p[f"f{w}"][j * EMBED:(j + 1) * EMBED])
        pair = (lambda w, j: (part(w, j)[:, None] + part(w, j + 1)[None]).reshape(65536, FILTERS))
        head = np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0)], 1).astype(np.float32)
        return head, part(3, 2).astype(np.float32), pair(4, 2).astype(np.float32)

    def logits(self, x: np.ndarray, tables) -> np.ndarray:
        head, third, tail = tables
        span = LENGTH - max(WIDTHS) + 1
        two = x[:, :-1].astype(np.int64) * 256 + x[:, 1:]
        f = FILTERS
        z = np.take(head, two[:, :span], axis=0, mode="clip")
        z[:, :, f:2 * f] += np.take(third, x[:, 2:span + 2], axis=0)
        z[:, :, 2 * f:] += np.take(tail, two[:, 2:span + 2], axis=0, mode="clip")
        b = np.concatenate([self.p[f"b{w}"] for w in WIDTHS])
        return np.maximum(z.max(1) + b, 0) @ self.p["out"] + self.p["bias"]


def train(labelled: DataFrame, max_docs: int = MAX_DOCS, steps: int = STEPS) -> Network | None:
    """Fit on (id, text, lang) rows; None without any. At most `max_docs` rows
    and `PER_DOC` windows of each reach the driver."""
    rows = labelled.where("text is not null and lang is not null and octet_length(text) > 0")
    rows = rows.orderBy(F.xxhash64(F.col("id").cast("string"), "text")).limit(max_docs).select("text", "lang")

    def sample(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                w, row, _ = cut_windows(Texts(part.column("text")))
                per = np.bincount(row, minlength=part.num_rows)
                first = np.cumsum(per) - per
                k = np.minimum(per, PER_DOC)
                j = ragged(np.zeros(len(k), np.int64), k)
                r = np.repeat(np.arange(len(k)), k)
                pick = first[r] + j * per[r] // k[r]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in w[pick]], pa.binary()),
                     part.column("lang").take(pa.array(r))], names=["w", "lang"])

    got = rows.mapInArrow(sample, "w binary, lang string").toPandas()
    if not len(got):
        return None
    langs = sorted(got["lang"].unique())
    x = np.frombuffer(b"".join(got["w"]), np.uint8).reshape(-1, LENGTH)
    y = np.searchsorted(np.array(langs, dtype=object), got["lang"].to_numpy(dtype=object))
    order = np.lexsort([got["w"].to_numpy(dtype=object).astype("S128"), y])  # the same at any partitioning
    net = Network(langs)
    net.fit(x[order], y[order].astype(np.int64), steps)
    return net


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"),
                      F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    if net is None:
        return src.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    model = docs.sparkSession.sparkContext.broadcast((net.langs, net.p))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = Network.__new__(Network)
        own.langs, own.p = model.value
        tables, langs = own.tables(), np.array(own.langs, dtype=object)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                t = Texts(part.column("text"))
                w, row, real = cut_windows(t)
                total = np.zeros((t.n, len(langs)))
                for k in range(0, len(w), 256):
                    z = own.logits(w[k:k + 256], tables)
                    np.add.at(total, row[k:k + 256], z * real[k:k + 256, None])
                z = total / np.maximum(np.diff(t.off), 1)[:, None]
                q = np.exp(z - z.max(1, keepdims=True))
                q /= q.sum(1, keepdims=True)
                best = q.argmax(1)
                letter = part.column("letter").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.where(letter, langs[best], UND), pa.string()),
                     pa.array(np.where(letter, q[np.arange(t.n), best], 0.0))],
                    names=["doc_id", "lang_pred", "score"])

    return src.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
