"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, stored  # noqa: F401  (the operators take them from here)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    return base if base.lower() not in taken else f"{base}_{uuid.uuid4().hex[:8]}"


def is_held_out(doc_id) -> Column:
    """crc32(doc_id as text) mod 4 is 2; null ids are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def tasks_for(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               df.sparkSession.sparkContext.defaultParallelism)


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links, as (node, component): the
    smallest node of each component for every node that has a link.

    Alternating large-star / small-star rounds. A round is two map-side
    combined minima and joins on the node (skewed nodes are split by adaptive
    execution); its links are written to the shared folder, so lineage stays
    flat. Nothing but a checksum of the written links comes to the driver."""

    def written(e: DataFrame):
        e = stored(e, "links")
        return e, tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    e, last = written(links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct())
    for _ in range(max_rounds if last[0] else 0):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        star = (both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v")
                .where("u < v").distinct())
        down = star.select(F.col("v").alias("x"), F.col("u").alias("y"))
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        j = down.join(low, "x")
        star = (j.select(F.col("m").alias("u"), F.col("y").alias("v"))
                .union(low.select(F.col("m").alias("u"), F.col("x").alias("v")))
                .where("u < v").distinct())
        old, (e, now) = e, written(star)
        discard(old)
        if now == last:
            break
        last = now
    else:
        if last[0]:
            raise RuntimeError("components did not converge")
    low = e.groupBy("v").agg(F.min("u").alias("component")).select(F.col("v").alias("node"), "component")
    return low.union(e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after more links: nodes with one component are
    connected, but connected nodes may keep different ones. Two steps to the
    smallest neighbour's smallest neighbour, which join a centre with all that
    link to it; `components` is the whole way."""
    links = links.select("a", "b")
    for col in ("a", "b") if comp is not None else ():
        to = comp.select(F.col("node").alias("_node"), F.col("component").alias("_to"))
        links = (links.join(to, F.col(col) == F.col("_node"), "left")
                 .withColumn(col, F.coalesce("_to", col)).drop("_node", "_to"))
    links = links.where("a <> b")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).withColumnRenamed("a", "x")
    low = (both.join(low, F.col("b") == F.col("x")).groupBy(F.col("a").alias("k"))
           .agg(F.least(F.col("a"), F.min("m")).alias("to")))
    if comp is None:
        return low.select(F.col("k").alias("node"), F.col("to").alias("component"))
    own = low.select(F.col("k").alias("node"), F.col("k").alias("component")).join(comp, "node", "left_anti")
    every = comp.select("node", "component").union(own)
    return (every.join(low, every.component == low.k, "left")
            .select("node", F.coalesce("to", "component").alias("component")))


def count_sketch(df: DataFrame, slots: Callable, bits: int, piece: int = 16) -> np.ndarray:
    """How often each of 2**bits slots is hit, 65535 at most; `slots` takes an
    Arrow batch of df and yields arrays of slots. Tasks send their counts in
    compressed pieces, empty ones not at all, which are added up piece by piece;
    2**bits counts come to the driver at any scale."""

    def count(batches):
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for slot in slots(batch):
                np.add.at(total, slot, 1)
        pieces = total.reshape(-1, 1 << piece)
        at = np.flatnonzero(pieces.any(1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array([pa.compress(pieces[k], codec="zstd", asbytes=True) for k in at], pa.binary())],
            names=["piece", "n"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("piece").to_pylist(), batch.column("n")):
                raw = pa.decompress(x.as_buffer(), decompressed_size=4 << piece, codec="zstd")
                if k not in total:
                    total[k] = np.zeros(1 << piece, np.uint64)
                total[k] += np.frombuffer(raw, np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.minimum(x, 65535).astype(np.uint16).tobytes() for x in total.values()], pa.binary())],
            names=["piece", "n"])

    n = 1 << (bits - piece)
    got = (df.mapInArrow(count, "piece int, n binary").repartition(min(n, 64), "piece")
           .mapInArrow(add, "piece int, n binary").toArrow())
    out = np.zeros((n, 1 << piece), np.uint16)
    for k, x in zip(got.column("piece").to_pylist(), got.column("n").to_pylist()):
        out[k] = np.frombuffer(x, np.uint16)
    return out.ravel()


ROUNDS = 16
FEW = 4


def group_links(rows: DataFrame, verify: Callable[[DataFrame], DataFrame], similar: int, tasks: int,
                finer: Callable[[DataFrame], DataFrame] | None = None,
                common: Callable[[Column], Column] | None = None) -> DataFrame:
    """Verified links (a, b) between things that share a group, enough to give
    every component, without all pairs of a group.

    rows: t (group), c (thing, long), n (its set's size) and, without `finer`,
    i (see there). Sets that differ too much in size are never compared. Stars
    come first: every group has a centre, and each thing is compared with one
    of the centres of its groups that are not in its component, the one it meets
    most often. Components are merged and the next star has other centres.
    One star is always made, so that large and small inputs take the same steps.
    Stars end when the groups hold at most `FEW` pairs of things in different
    components for each of their rows, when two stars together have taken away
    less than a tenth of these pairs, or after `ROUNDS`. Then every pair with a
    common group that is still in different components is compared, so no
    component is missed and the number of stars settles only the cost. `verify`
    takes pairs (a, b) and returns the similar ones as a stored frame.

    With `finer`, the things (c) that are still apart are grouped anew before
    that, by groups (t, c, n, i): t is the i-th token, from 0, of a set of n
    under one order of all tokens, and any two similar things meet. `common`
    gives, for the smaller set's size, in how many of these groups two similar
    things meet at least.

    Two similar sets of n and m tokens share `need` of them or more. Their first
    `common` shared tokens then have need - common others behind them in both
    sets, so tokens meet only at places before n - need + common and
    m - need + common."""
    near = (lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * similar)

    def open_rows(r, comp):
        """Rows of the groups that hold several components, with the component k
        and the number of the group's rows."""
        r = (r.withColumn("k", F.col("c")) if comp is None else
             r.join(comp, r.c == comp.node, "left").select(*r.columns, F.coalesce("component", "c").alias("k")))
        group = (r.groupBy("t").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("size"))
                 .where("lo < hi").select(F.col("t").alias("group"), "size"))
        return r.join(group, r.t == group.group).drop("group")

    def star_of(r, turn):
        """A pair (a, b) for each thing: itself and a centre. A group's centre is
        one of its things that meet most others, by their meetings times a
        number of 0.75 to 1 that changes with the turn: things at the edge of a
        group are similar to few."""
        luck = 0.75 + F.pmod(F.xxhash64("c", F.lit(turn)), F.lit(1 << 20)) / (1 << 22)
        met = r.groupBy("c").agg((F.sum("size") * luck).alias("w")).withColumnRenamed("c", "thing")
        centre = (r.join(met, r.c == met.thing).groupBy("t").agg(F.max(F.struct("w", "c", "n", "k")).alias("centre"))
                  .withColumnRenamed("t", "group"))
        return (r.join(centre, r.t == centre.group)
                .where((F.col("k") != F.col("centre.k")) & near(F.col("n"), F.col("centre.n")))
                .groupBy("c", F.col("centre.c").alias("o")).agg(F.count(F.lit(1)).alias("met"))
                .groupBy("c").agg(F.max_by("o", F.struct("met", "o")).alias("o"))
                .select(F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b")).distinct())

    def apart(r):
        """(pairs of rows of one group in different components, rows)"""
        per = (r.groupBy("t", "k").agg(F.count(F.lit(1)).cast("double").alias("m"))
               .groupBy("t").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own")))
        return tuple(x or 0.0 for x in per.agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2), F.sum("m")).first())

    several = rows.groupBy("t").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    left = stored(rows.join(several, "t", "left_semi").dropDuplicates(["t", "c"]), "shared")
    comp, links, tried, loads = None, [], [], []
    for turn in range(ROUNDS + 1):
        now = stored(open_rows(left, comp), "open")
        discard(left)
        left = now.drop("k", "size")
        left._stored_at = now._stored_at
        load, n = apart(now)
        loads.append(load)
        if not load or (turn and load <= FEW * n) or turn == ROUNDS or (turn > 1 and 10 * load > 9 * loads[-3]):
            break
        star = star_of(now, turn)
        for old in tried:
            star = star.join(old, ["a", "b"], "left_anti")
        star = stored(star, "star")
        found = verify(star)
        tried.append(star)
        links.append(found)
        if not found.isEmpty():
            old, comp = comp, stored(merged(comp, found), "components")
            discard(old)

    if finer is not None:
        now = stored(open_rows(finer(now.select("c").distinct()).repartition(tasks, "t"), comp), "open")
    other = now.select("t", F.col("c").alias("b"), F.col("n").alias("m"), F.col("k").alias("k2"), F.col("i").alias("j"))
    least = common or (lambda n: F.lit(1))
    room = least(F.least("n", "m")) - F.ceil((F.col("n") + F.col("m")) * similar / (100 + similar))
    may = ((F.col("c") < F.col("b")) & (F.col("k") != F.col("k2")) & near(F.col("n"), F.col("m"))
           & (F.col("i") < F.col("n") + room) & (F.col("j") < F.col("m") + room))
    rest = (now.join(other, "t").where(may)
            .groupBy(F.col("c").alias("a"), "b").agg(F.count(F.lit(1)).alias("met"),
                                                     F.first(F.least("n", "m")).alias("least"))
            .where(F.col("met") >= least(F.col("least"))).select("a", "b"))
    for old in tried:
        rest = rest.join(old, ["a", "b"], "left_anti")
    rest = stored(rest, "rest")
    discard(left)
    discard(now)
    return union_all([*links, verify(rest)])
