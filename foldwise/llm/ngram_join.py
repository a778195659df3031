"""N-gram Jaccard join by prefix filters under several global orders
(operator 5).

A document's set holds its distinct 5-word shingles (64-bit hashes). Two sets
with a Jaccard similarity of 0.75 or more share a token among the first
n - ceil(0.75 n) + 1 tokens of each, under any order of all tokens. The first
order puts rare tokens first: frequencies come from a count sketch of fixed
size over all documents, and only prefixes are shuffled, by token; they are a
twentieth longer than that, and share a twentieth of the smaller set at least.
The other orders are random permutations; a candidate pair must share prefix tokens
under every one of them before the sets are compared exactly.

Equal sets are one class. To emit no pairs inside large groups, each class is
first compared with one class of its token groups, star by star; the links found
join most of a group. Then only pairs of classes that are still in different
components are compared, all that share enough tokens at places where similar
sets can share them, so components are exact.

Null and empty texts have empty sets and are linked with nothing. Rows with a
null id are returned without component. Rows that repeat an id are one
document for links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, count_sketch, discard, group_links, stored, tasks_for
from .kernels import SPACE, Texts, gram_hash, mix, ragged, run_hash, signed, slices

GRAM = 5
SIMILAR = 75
SKETCH_BITS = 22
COMMON = 20
SALTS = (0x51ED270B, 0x2545F491)


def shingles(col: pa.Array, gram: int):
    """Distinct shingles of a slice's rows: (hashes, ascending in each row; row
    borders)."""
    t = Texts(col, lower=True)
    starts, ends, wo = t.words(SPACE)
    h = t.word_hash(starts, ends)
    size = np.diff(wo)
    n = np.where(size >= gram, size - gram + 1, 0)
    g = gram_hash(h, gram)
    row = np.repeat(np.arange(t.n), n)
    tokens = g[ragged(wo[:-1], n)] if len(g) else np.zeros(0, np.uint64)
    short = np.flatnonzero((size > 0) & (size < gram))
    if len(short):  # the whole sequence is one shingle
        row = np.concatenate([row, short])
        tokens = np.concatenate([tokens, run_hash(h, wo[short], wo[short + 1])])
    order = np.lexsort((tokens, row))
    row, tokens = row[order], tokens[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (tokens[1:] != tokens[:-1])
    row, tokens = row[keep], tokens[keep]
    return tokens, np.searchsorted(row, np.arange(t.n + 1))


def prefix_size(n: np.ndarray, similar: int, common: int = 0) -> np.ndarray:
    """Length of the prefixes in which two similar sets share a token; with
    `common`, max(1, n // common) tokens for the size n of the smaller set."""
    more = np.maximum(n // common, 1) if common else 1
    return np.where(n > 0, np.minimum(n - -(-similar * n // 100) + more, n), 0)


def prefixes(tokens: np.ndarray, bounds: np.ndarray, key: np.ndarray, similar: int, common: int = 0):
    """The tokens of each row that come first in the order of `key`."""
    n = np.diff(bounds)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((tokens, key, row))
    k = prefix_size(n, similar, common)
    return tokens[order][ragged(bounds[:-1], k)], np.concatenate([[0], np.cumsum(k)])


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(values)))


def frequency_sketch(docs: DataFrame, gram: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Documents by hash slot of their shingles."""

    def slots(batch):
        for part in slices(batch, "text"):
            yield (shingles(part.column("text"), gram)[0] >> np.uint64(64 - bits)).astype(np.int64)

    return count_sketch(docs.select("text"), slots, bits)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", gram: int = GRAM,
                      similar: int = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(documents, links): doc_id, n_shingles, component_id for every row of
    docs; and verified links between classes, as the smallest ids of both
    classes, a and b. The links span every component but are not all similar
    pairs: classes that earlier links joined are not compared again."""
    spark, bits = docs.sparkSession, SKETCH_BITS
    src = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text).alias("text"))
    sketch = spark.sparkContext.broadcast(frequency_sketch(src, gram))

    def first_pass(batches):
        count = sketch.value
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, bounds = shingles(part.column("text"), gram)
                n = np.diff(bounds)
                c = class_of(tokens, bounds)
                head, hb = prefixes(tokens, bounds, count[(tokens >> np.uint64(64 - bits)).astype(np.int64)], similar,
                                    COMMON)
                yield pa.RecordBatch.from_arrays(
                    [part.column("d"), pa.array(n.astype(np.int64)), pa.array(c), _lists(head, hb)],
                    names=["d", "n", "c", "head"])

    heads = stored(src.mapInArrow(first_pass, "d long, n long, c long, head array<long>"), "heads")
    meta = stored(heads.select("d", "n", "c"), "sizes")
    classes = stored(meta.where("n > 0 and d is not null").groupBy("c").agg(F.min("d").alias("low")), "classes")
    # classes by prefix token, in the first order
    rows = (heads.where("d is not null")
            .select(F.posexplode("head").alias("i", "t"), "c", F.col("n").cast("int").alias("n")))
    links = group_links(rows, lambda pairs: _verified(pairs, src, classes, gram, similar), similar, tasks_for(docs),
                        common=lambda n: F.greatest(F.floor(n / COMMON), F.lit(1)))
    discard(heads)
    comp = components(links)
    low = classes.join(comp, classes.c == comp.node, "left").select("c", "low", F.coalesce("component", "c").alias("k"))
    root = low.groupBy("k").agg(F.min("low").alias("component_id"))
    of = low.join(root, "k").select(F.col("c").alias("c2"), "component_id")
    out = (meta.join(of, (meta.c == F.col("c2")) & (meta.n > 0) & meta.d.isNotNull(), "left")
           .select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"),
                   F.coalesce("component_id", "d").alias("component_id")))
    ids = classes.select(F.col("c").alias("x"), "low")
    pairs = (links.join(ids, F.col("a") == F.col("x")).select(F.col("low").alias("a1"), "b")
             .join(ids, F.col("b") == F.col("x")).select(F.col("a1").alias("a"), F.col("low").alias("b")))
    return out, pairs


def _verified(pairs: DataFrame, src: DataFrame, classes: DataFrame, gram: int, similar: int) -> DataFrame:
    """Pairs (a, b) of classes that share prefix tokens under every other order
    and then pass the exact test, on the texts of each class's smallest
    document. A prefix is kept as 32 bits a token: equal tokens stay equal, so
    the filter only ever lets more pairs through. Texts are joined to the pairs
    that it leaves."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(classes, "c")
    one = src.join(wanted, src.d == wanted.low).select("c", "text")
    heads = [f"head{k}" for k in range(len(SALTS))]

    def own(batches):
        """The class's own text (rows that repeat an id may hold another one, of
        another class) with its prefixes under the other orders."""
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, bounds = shingles(part.column("text"), gram)
                first = [prefixes(tokens, bounds, mix(tokens ^ np.uint64(s)), similar) for s in SALTS]
                out = pa.RecordBatch.from_arrays(
                    [part.column("c"), part.column("text"),
                     *(pa.ListArray.from_arrays(pa.array(b.astype(np.int32)), pa.array(v.astype(np.uint32).view(np.int32)))
                       for v, b in first)], names=["c", "text", *heads])
                yield out.filter(pa.array(class_of(tokens, bounds) == part.column("c").to_numpy()))

    kind = "c long, text string, " + ", ".join(f"{h} array<int>" for h in heads)
    texts = stored(one.mapInArrow(own, kind), "texts")
    left = texts.select(F.col("c").alias("a"), *heads)
    right = texts.select(F.col("c").alias("b"), *(F.col(h).alias(f"{h}_b") for h in heads))
    both = pairs.join(left, "a").join(right, "b")
    for h in heads:
        both = both.where(F.arrays_overlap(h, f"{h}_b"))
    both = (both.select("a", "b").distinct().join(texts.select(F.col("c").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("c").alias("b"), F.col("text").alias("y")), "b"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "x", 1 << 20):
                yield _compare(part, gram, similar)

    out = stored(both.mapInArrow(run, "a long, b long").distinct(), "links")
    discard(texts)
    return out


def class_of(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number for a set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ np.uint64(0xA5A5)))])
    return signed(mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))


def _common(x, bx, y, by, n: int) -> np.ndarray:
    """Number of common tokens of each pair of sorted sets."""
    row = np.concatenate([np.repeat(np.arange(n), np.diff(bx)), np.repeat(np.arange(n), np.diff(by))])
    both = np.concatenate([x, y])
    order = np.lexsort((both, row))
    row, both = row[order], both[order]
    same = (row[1:] == row[:-1]) & (both[1:] == both[:-1])
    return np.bincount(row[1:][same], minlength=n)


def _compare(part: pa.RecordBatch, gram: int, similar: int) -> pa.RecordBatch:
    n = part.num_rows
    x, bx = shingles(part.column("x"), gram)
    y, by = shingles(part.column("y"), gram)
    both = _common(x, bx, y, by, n)
    keep = 100 * both >= similar * (np.diff(bx) + np.diff(by) - both)
    return part.select(["a", "b"]).filter(pa.array(keep))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", gram: int = GRAM,
                similar: int = SIMILAR) -> DataFrame:
    """One document of each group of similar ones stays, with all its columns:
    the one with the smallest id. Documents without words or id stay. Rows that
    repeat an id all stay if it does."""
    found, _ = similar_documents(docs, id_col, text, gram, similar)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("_gone"), "left_anti")
