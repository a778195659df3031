"""Mixing sources to target weights by hash-threshold histograms (operator 6).

Every document has a 60-bit hash of its id and text. A source takes whole
passes over its documents while its target allows, and of the next pass the
documents with the smallest hashes. The threshold comes from nested
histograms: words by source and leading hash bits; the bucket in which the
budget ends is split by the next bits, and only its documents are counted
again, until the bucket is one document. It is taken if that brings the source
nearer to its target. Nothing is sorted, a larger budget keeps what a smaller
one took, and reruns agree.

A null text has 0 words. Null sources are one source, after all others. Rows
that repeat id and text share their hash and are taken together. Documents
without words are never taken. An empty table gives an empty mix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.indexing import global_index
from .common import discard, fresh, stored

WEIGHTS = (1, 2, 3)
MOST = 3
BITS = 10
LEVELS = 6
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def place(id_col: str, text: str) -> Column:
    """60 bits of hash."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.col(text)), 64 - BITS * LEVELS)


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target from (source, size): all words are shared by
    weight; a target stops at `most` times its source, and what is over goes to
    the others by weight until none is above. Weights repeat over the sources
    in code point order, null last."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("none", F.col("source").isNull())
    s = global_index(s, ["none", "source"], "rank")
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    s = stored(s.select("source", "source_size", w.alias("w")), "sources")
    total = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    limit = F.col("source_size") * most
    share, full = None, -1
    while True:  # the set of full sources only grows
        over = F.lit(False) if share is None else F.col("w") * share > limit
        n, left, weight = s.agg(
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
            F.lit(total) - F.coalesce(F.sum(F.when(over, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0.0))).first()
        if n == full or not weight:
            break
        full, share = n, left / weight
    return s.select("source", "source_size",
                    F.least(F.col("w") * float(share or 0.0), limit.cast("double")).alias("target"))


def thresholds(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """source, source_size, target, passes, upto: documents with a hash of at
    most `upto` are taken once more than `passes` times. sized: source, size, h
    (stored)."""
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    now = goal.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * size)
    now = stored(now.withColumns({"prefix": F.lit(0).cast("long"), "done": F.col("rest") <= 0,
                                  "upto": F.lit(-1).cast("long")}), "budgets")
    for level in range(1, LEVELS + 1):
        if now.where("not done").isEmpty():
            break
        low = BITS * (LEVELS - level)
        live = now.where("not done").select(F.col("source").alias("s"), F.col("prefix").alias("p"))
        b = F.shiftright("h", low)
        hist = (sized.where("size > 0").join(live, sized.source.eqNullSafe(F.col("s")))
                .where(F.shiftright("h", low + BITS) == F.col("p"))
                .groupBy("source", b.alias("b")).agg(F.sum("size").alias("n"), F.max("h").alias("top")))
        w = Window.partitionBy("source").orderBy("b")  # 1024 buckets at most
        cum = hist.withColumn("after", F.sum("n").over(w)).withColumn("before", F.col("after") - F.col("n"))
        cum = cum.withColumnRenamed("source", "s2")
        j = now.join(cum, now.source.eqNullSafe(F.col("s2")) & ~F.col("done")
                     & (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("after")), "left")
        # the last level's bucket is one hash: take it if that is nearer
        last = level == LEVELS
        inside = F.col("b").isNotNull()
        step = {"prefix": F.when(inside, F.col("b")).otherwise(F.col("prefix")),
                "upto": F.when(inside, F.shiftleft(F.col("b"), low) - 1).otherwise(F.col("upto"))}
        if last:
            step["upto"] = F.when(inside & ((F.col("rest") - F.col("before")) * 2 >= F.col("n")), F.col("b")).otherwise(
                step["upto"])
        nxt = j.select("source", "source_size", "target", "passes",
                       (F.col("rest") - F.coalesce("before", F.lit(0))).alias("rest"),
                       step["prefix"].alias("prefix"),
                       (F.col("done") | ~inside | F.lit(last)).alias("done"), step["upto"].alias("upto"))
        old, now = now, stored(nxt, "budgets")
        discard(old)
    return now.select("source", "source_size", "target", "passes", "upto")


def copies(h: Column) -> Column:
    """Times that a document is taken, given its source's thresholds."""
    return F.col("passes") + (h <= F.col("upto")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken."""
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                               n_words(text).alias("size"), place(id_col, text).alias("h")), "sized")
    plan = thresholds(sized, targets(sized, weights, most)).withColumnRenamed("source", "s")
    return (sized.join(plan, sized.source.eqNullSafe(F.col("s")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("h"))).alias("taken")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
          out: str = "copies", weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents that the mix takes, with all their columns and how often
    each is taken (`copies`)."""
    size, h, own, out = fresh(docs, "_size"), fresh(docs, "_h"), fresh(docs, "_source"), fresh(docs, out)
    sized = stored(docs.select(F.col(source).alias("source"), n_words(text).alias("size"),
                               place(id_col, text).alias("h")), "sized")
    plan = thresholds(sized, targets(sized, weights, most)).select(
        F.col("source").alias(own), F.struct("passes", "upto").alias(size))
    n = F.when(n_words(text) > 0, F.col(f"{size}.passes") + (place(id_col, text) <= F.col(f"{size}.upto")).cast("long"))
    return (docs.join(plan, docs[source].eqNullSafe(F.col(own))).withColumn(out, F.coalesce(n, F.lit(0)))
            .where(F.col(out) > 0).drop(size, h, own))
