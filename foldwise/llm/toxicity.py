"""Toxicity by maximum-scoring segments (operator 1).

Tokens are words and the beginnings of words, which catch inflected and
compound forms. Every token has a log-odds score: how much likelier it is in
toxic than in other documents, with a Dirichlet prior drawn from the token
counts of the whole corpus, drawn in by `CAUTION` standard errors, 0
below `LEAST_ODDS` (slight differences, as between languages, are no evidence),
less a small drift. A word scores like its best token. A linear scan of each document finds
all maximal-scoring segments: passages that cannot be made better by growing
or shrinking. A segment's score becomes an expected number of equally good
chance segments (extreme-value law with the scale and the location of the
corpus's clean documents); segments below `EXPECT` are reported. The document
score is a logistic fit of the best segment's extreme-value statistic and the
sum over its significant segments.

Labels are used from at most `max_labels` documents of each class (smallest
hash of the id), two thirds for the token scores, the rest for the calibration,
and at most `max_tokens` tokens can score above the drift, those with most evidence:
documented bounds of the classifier. The prior counts cover all documents.

Null and empty texts hold no segment and score like any document without one.
Without labels of both classes every score is 0."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .kernels import NON_ALNUM, Texts, mix, signed, slices

STEMS = (4, 5, 6)
MAX_TOKENS = 1 << 16
MAX_LABELS = 8000
PRIOR = 10000.0
CAUTION = 2.0
LEAST_ODDS = 1.0
DRIFT = 0.05
EXPECT = 0.05
SEGMENT = "array<struct<at: long, n: long, score: double, expected: double>>"


def tokens(t: Texts):
    """(hashes of every word's tokens, row borders). A word's tokens are its
    first 4, 5 and 6 bytes and the whole word."""
    starts, ends, wo = t.words(NON_ALNUM)
    size = np.minimum(ends - starts, 8)
    v = t.load8()[starts] if len(starts) else np.zeros(0, np.uint64)
    mask = np.array([(1 << (8 * i)) - 1 for i in range(8)], np.uint64)
    out = [mix((v & mask[np.minimum(size, k)]) ^ np.uint64(k << 56)) for k in STEMS]
    out.append(t.word_hash(starts, ends))
    return np.stack(out, 1), wo


class Lexicon:
    """Position of a token hash in a bounded, sorted list; -1 if not there."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys  # sorted, unique
        self.bits = np.zeros(1 << 20, bool)
        self.bits[keys >> np.uint64(44)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(h.shape, -1, np.int64)
        near = np.flatnonzero(self.bits[(h >> np.uint64(44)).ravel()])
        if len(near):
            x = h.ravel()[near]
            i = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
            out.ravel()[near] = np.where(self.keys[i] == x, i, -1)
        return out


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments [from, to) of one document in linear time.
    Neighbouring words with a positive score enter as one."""
    up = score > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], up, [False]]).astype(np.int8)))
    if not len(edge):
        return []
    total = np.concatenate([[0.0], np.cumsum(score, dtype=np.float64)])
    held: list[list] = []  # [from, to, total before, total after, last one that began lower]
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        left, right = total[a], total[b]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j = held[j][4]
            if j < 0 or held[j][3] >= right:
                held.append([a, b, left, right, j])
                break
            a, left = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, float(r - l)) for a, b, l, r, _ in held]


def _seen(docs: DataFrame) -> DataFrame:
    """Occurrences of tokens in toxic and other documents: token, bad, other.
    docs: text, kind (1 or 0); tasks add up each slice first."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, wo = tokens(Texts(part.column("text")))
                kind = np.repeat(part.column("kind").to_numpy(), np.diff(wo) * h.shape[1])
                key, at = np.unique(h.ravel(), return_inverse=True)
                bad = np.bincount(at.ravel(), kind == 1, len(key)).astype(np.int64)
                n = np.bincount(at.ravel(), minlength=len(key))
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(bad), pa.array(n - bad)],
                                                 names=["token", "bad", "other"])

    return (docs.mapInArrow(run, "token long, bad long, other long").groupBy("token")
            .agg(F.sum("bad").alias("bad"), F.sum("other").alias("other")))


def _everywhere(docs: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Occurrences of the chosen tokens in all documents, and all tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        words, total, n = Lexicon(shared.value), np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                h, _ = tokens(Texts(part.column("text")))
                at = words.find(h)
                n += h.size
                total += np.bincount(at[at >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))],
                                         names=["at", "n"])

    got = docs.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = got.column("at").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(len(keys), np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def token_scores(n, bad, other, n_all: int, n_bad: int, n_other: int, prior: float = PRIOR,
                 caution: float = CAUTION, drift: float = DRIFT) -> np.ndarray:
    """Log-odds with a Dirichlet prior in proportion to the corpus's counts."""
    a = prior * (n + 0.5) / max(n_all, 1)
    odds = (lambda y, total: np.log((y + a) / np.maximum(total + prior - y - a, 1)))
    delta = odds(bad, n_bad) - odds(other, n_other)
    error = np.sqrt(1 / (bad + a) + 1 / (other + a))
    sure = delta - caution * error
    return (np.where(sure >= LEAST_ODDS, sure, 0) - drift).astype(np.float32)


def _labels(labels: DataFrame, id_col: str, label: str, max_labels: int) -> DataFrame:
    """At most `max_labels` ids of each class; an id with several labels is
    toxic if one of them is."""
    one = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
           .agg(F.max(F.col(label).cast("int")).alias("kind")))
    one = one.withColumn("h", F.xxhash64(F.col("label_id").cast("string"), F.lit(7)))
    parts = [one.where(F.col("kind") == k).orderBy("h").limit(max_labels) for k in (0, 1)]
    return parts[0].union(parts[1]).select("label_id", "kind", (F.pmod("h", F.lit(3)) > 0).alias("first"))


class Model:
    """Token scores and the calibration; both of bounded size."""

    def __init__(self, keys, scores, scale=1.0, place=0.0, weights=None):
        self.keys, self.scores, self.scale, self.place, self.weights = keys, scores, scale, place, weights
        self.words, self.table = Lexicon(keys), np.append(scores, np.float32(-DRIFT))

    def parts(self):
        return self.keys, self.scores, self.scale, self.place, self.weights

    def statistic(self, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Minus the log of the number of chance segments expected to do as well."""
        return (s - self.place) / self.scale - np.log(np.maximum(n, 1))

    def features(self, part_text):
        """Of each row: best score, words, features; and the segments."""
        t = Texts(part_text)
        h, wo = tokens(t)
        value = self.table[self.words.find(h)].max(1) if len(h) else np.zeros(0, np.float32)
        best, total, found = np.zeros(t.n), np.zeros(t.n), []
        for r in range(t.n):
            segs = maximal_segments(value[wo[r]:wo[r + 1]])
            n = int(wo[r + 1] - wo[r])
            keep = []
            if segs:
                s = np.array([x[2] for x in segs])
                best[r] = s.max()
                stat = self.statistic(s, n)
                ok = stat >= -np.log(EXPECT)
                total[r] = stat[ok].sum()
                keep = [{"at": a, "n": b - a, "score": c, "expected": float(np.exp(-st))}
                        for (a, b, c), st, o in zip(segs, stat, ok) if o]
            found.append(keep)
        return best, np.diff(wo), total, found

    def inputs(self, best, n, total):
        return np.stack([np.ones(len(best)), np.clip(self.statistic(best, n), -20, 60) / 10,
                         np.log1p(total), best / 10, np.log1p(n) / 5], 1)

    def probability(self, best, n, total):
        if self.weights is None:
            return np.zeros(len(best))
        return 1 / (1 + np.exp(-self.inputs(best, n, total) @ self.weights))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (y - p)) - 0.1 * b
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(b))
        step = np.clip(np.linalg.solve(h, g), -3, 3)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def _measure(docs: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """Features of a bounded set of labelled documents."""
    m = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        own = Model(*m.value)
        for batch in batches:
            for part in slices(batch, "text"):
                best, n, total, _ = own.features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("kind"), pa.array(best), pa.array(n.astype(np.int64)), pa.array(total)],
                    names=["kind", "best", "n", "total"])

    got = docs.mapInArrow(run, "kind int, best double, n long, total double").toArrow()
    return {c: got.column(c).to_numpy() for c in got.column_names}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_id: str = "doc_id",
        label: str = "toxic", max_labels: int = MAX_LABELS, max_tokens: int = MAX_TOKENS) -> Model | None:
    """Token scores from two thirds of the labels and the whole corpus's counts,
    calibration on the others. `labels` holds only rows to learn from."""
    share = {r["kind"]: r["n"] for r in labels.groupBy(F.col(label).cast("int").alias("kind"))
             .agg(F.count(F.lit(1)).alias("n")).where("kind in (0, 1)").collect()}
    if len(share) < 2:
        return None
    src = docs.select(F.col(id_col).alias("label_id"), F.col(text).alias("text"))
    # broadcast: 2 * max_labels rows of (id, class, half) at most
    known = stored(src.join(F.broadcast(_labels(labels, label_id, label, max_labels)), "label_id")
                   .select("text", "kind", "first"), "labelled")
    seen = stored(_seen(known.where("first").select("text", "kind")), "tokens")
    n_bad, n_other = seen.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("other"), F.lit(0))).first()
    if not n_bad or not n_other:
        return None
    odds = F.log((F.col("bad") + 0.5) / n_bad) - F.log((F.col("other") + 0.5) / n_other)
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("other") + 0.5))
    best = (seen.where("bad > 1").withColumn("z", odds - CAUTION * error).where("z > 0")
            .orderBy(F.desc("z"), "token").limit(max_tokens).toArrow())
    order = np.argsort(best.column("token").to_numpy().view(np.uint64))
    keys = best.column("token").to_numpy().view(np.uint64)[order]
    bad, other = (best.column(c).to_numpy()[order] for c in ("bad", "other"))
    if not len(keys):
        return None
    n, n_all = _everywhere(src.select("text"), keys)
    scores = token_scores(n, bad, other, n_all, n_bad, n_other)
    up = scores > 0
    if not up.any():
        return None
    model = Model(keys[up], scores[up])
    rest = known.where("not first").select("text", "kind")
    calibrate(model, lambda: _measure(rest, model), share)
    return model


def calibrate(model: Model, measure, share: dict[int, int]) -> None:
    """Extreme-value scale and location from the clean documents, then the
    logistic weights; classes weigh as in `share`."""
    x = measure()
    clean = (x["kind"] == 0) & (x["best"] > 0)
    if clean.sum() >= 20:  # Gumbel by moments, with the location of one word
        z = x["best"][clean]
        model.scale = max(float(z.std() * np.sqrt(6) / np.pi), 0.1)
        model.place = float(z.mean() - 0.5772 * model.scale - model.scale * np.log(np.maximum(x["n"][clean], 1)).mean())
        x = measure()
    if not len(x["kind"]):
        return
    bad = x["kind"] == 1
    w = np.where(bad, share[1] / max(bad.sum(), 1), share[0] / max((~bad).sum(), 1))
    model.weights = _logistic(model.inputs(x["best"], x["n"], x["total"]), bad.astype(float), w / w.mean())


def _shared(spark, model: Model | None):
    m = model or Model(np.zeros(1, np.uint64), np.full(1, -DRIFT, np.float32))
    return spark.sparkContext.broadcast(m.parts())


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score, segments (significant ones: first
    word, words, score, expected number of chance segments as good)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    shared = _shared(docs.sparkSession, model)
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                best, n, total, found = own.features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(own.probability(best, n, total)),
                     pa.array(found, pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64()),
                                                         ("score", pa.float64()), ("expected", pa.float64())])))],
                    names=["doc_id", "score", "segments"])

    return src.mapInArrow(run, f"doc_id {kind}, score double, segments {SEGMENT}")


def keep_clean(docs: DataFrame, model: Model | None, limit: float, text: str = "text") -> DataFrame:
    """The documents that score below `limit`, with all their columns."""
    shared = _shared(docs.sparkSession, model)

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, text):
                best, n, total, _ = own.features(part.column(text))
                yield part.filter(pa.array(own.probability(best, n, total) < limit))

    return docs.mapInArrow(run, docs.schema)
