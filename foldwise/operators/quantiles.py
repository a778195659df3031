"""Exact linear-interpolated quantiles by distributed selection.

`percentile()` keeps every distinct value of a group in one aggregation
buffer, and a sort moves every row. Here the value range is cut into `BINS`
equal ranges and rows are only counted into them, with map-side combining; of
these, only the ranges that hold a wanted rank are cut again. A range with few
rows, or with one value however often, is settled. All columns (and all groups)
share a pass; nothing is sorted and no row reaches the driver before its range
is small.

Interpolation: position (n-1)·q, value = v[lo] + (v[hi]-v[lo])·frac, as in
numpy's/pandas' "linear" method and SQL `quantile_cont`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import num
from .state import StateTable

BINS = 4096
SMALL = 4096  # rows of a range that are looked at one by one
SMALL_GROUP = 16384  # values of a group (or range of a group) gathered in one row


def _finite(v) -> Column:
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def _range(v) -> list[Column]:
    """Rows, ends and finite ends of a set of values, as aggregates."""
    return [F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
            F.min(_finite(v)).alias("flo"), F.max(_finite(v)).alias("fhi")]


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """Range of v among BINS equal ranges of the finite values [lo, hi]; never
    falls as v grows, and the two ends are in different ranges. Halves keep the
    width of any two finite numbers finite."""
    width = hi / 2 - lo / 2
    b = F.when(width > 0, F.least(F.floor(F.try_divide(v / 2 - lo / 2, width) * BINS), F.lit(BINS - 1)))
    return (F.when(v == -F.lit(float("inf")), F.lit(-1)).when(v == F.lit(float("inf")), F.lit(BINS))
            .otherwise(F.coalesce(b, (v > lo).cast("long"), F.lit(0)))).cast("double")


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    lo = int(math.floor(q * (n - 1)))
    return lo, min(lo + 1, n - 1), q * (n - 1) - lo


def column_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Quantiles of several columns over the whole table (NULL/NaN skipped), all
    in the same passes: one for the ranges, one for each cut."""
    cols = list(wanted)
    vals = df.select(*[num(c).alias(f"v{i}") for i, c in enumerate(cols)])
    names = ("n", "lo", "hi", "flo", "fhi")
    first = vals.agg(*[e.alias(f"{k}{i}") for i in range(len(cols)) for k, e in zip(names, _range(F.col(f"v{i}")))]).first()
    found: list[dict] = [{} for _ in cols]
    live: list[list[dict]] = []  # per column: the ranges that still hold wanted ranks
    for i, c in enumerate(cols):
        r = {k: first[f"{k}{i}"] for k in names}
        ranks = {x for q in wanted[c] for x in _ranks(r["n"], q)[:2]} if r["n"] else set()
        live.append([{**r, "before": 0, "ranks": ranks}] if ranks else [])
    while True:
        for i, ranges in enumerate(live):
            for r in ranges:
                if r["lo"] == r["hi"]:
                    found[i] |= dict.fromkeys(r["ranks"], r["lo"])
            live[i] = [r for r in ranges if r["lo"] != r["hi"]]
        if not any(live):
            break
        parts = []
        for i, ranges in enumerate(live):
            v, which = F.col(f"v{i}"), None
            for k, r in enumerate(ranges):
                # small ranges are counted by value, others by finer range
                key = v if r["n"] <= SMALL else _bin(v, F.lit(r["flo"]).cast("double"), F.lit(r["fhi"]).cast("double"))
                inside = (v >= F.lit(r["lo"])) & (v <= F.lit(r["hi"]))
                hit = F.struct(F.lit(i).alias("c"), F.lit(k).alias("k"), key.alias("key"), v.alias("v"))
                which = F.when(inside, hit) if which is None else which.when(inside, hit)
            if which is not None:
                parts.append(which)
        rows = (vals.select(F.explode(F.array(*parts)).alias("x")).where("x is not null")
                .groupBy("x.c", "x.k", "x.key").agg(*_range(F.col("x.v"))).collect())
        seen: dict = {}
        for r in rows:
            seen.setdefault((r["c"], r["k"]), []).append(r)
        nxt: list[list[dict]] = [[] for _ in cols]
        for (i, k), got in seen.items():
            before = live[i][k]["before"]
            for r in sorted(got, key=lambda r: r["key"]):
                hit = {x for x in live[i][k]["ranks"] if before <= x < before + r["n"]}
                if hit:
                    nxt[i].append({**{m: r[m] for m in names}, "before": before, "ranks": hit})
                before += r["n"]
        live = nxt
    out = {}
    for i, c in enumerate(cols):
        out[c] = []
        for q in wanted[c]:
            if not found[i]:
                out[c].append(None)
                continue
            lo, hi, frac = _ranks(first[f"n{i}"], q)
            a, b = found[i][lo], found[i][hi]
            out[c].append(a if a == b else a + (b - a) * frac)
    return out


def global_quantiles(df: DataFrame, value_col: str, probs: list[float]) -> list[float | None]:
    """Quantiles of one column over the whole table (NULL/NaN skipped)."""
    return column_quantiles(df, {value_col: probs})[value_col]


def grouped_quantiles(df: DataFrame, value_col: str, probs: list[float], by: list[str],
                      names: list[str]) -> StateTable:
    """Per-group quantiles → materialised state table (by..., names...).

    Groups of up to SMALL_GROUP rows are gathered whole. Larger ones, hot keys
    among them, are cut into ranges until the ranges at the wanted ranks are
    that small; their rows meet the table of ranges in a join whose hot keys
    are split (or which is a broadcast, when the table's size allows)."""
    rows = df.select(*[F.col(b) for b in by], num(value_col).alias("_v")).where(F.col("_v").isNotNull())
    for b in by:
        rows = rows.where(F.col(b).isNotNull())
    v = F.col("_v")
    stats = StateTable.build(rows.groupBy(*by).agg(*_range(v)))
    large = stats.df.where(F.col("n") > SMALL_GROUP)
    held = [stats]
    if large.isEmpty():
        lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list("_v")).alias("_l"))
        got = lists.select(*by, F.lit(0).cast("long").alias("_b"), F.size("_l").cast("long").alias("_m"), "_l")
        whole = got.withColumn("_n", F.col("_m"))
    else:
        pos = F.explode(F.array(*[F.lit(float(q)) for q in probs]))
        want = large.select(*by, "n", pos.alias("_q")).withColumn("_p", F.col("_q") * (F.col("n") - 1))
        want = want.select(*by, F.explode(F.array(F.floor("_p"), F.least(F.floor("_p") + 1, F.col("n") - 1))).alias("_r"))
        want = StateTable.build(want.distinct())
        held.append(want)
        ranges = large.withColumn("_b", F.lit(0).cast("long"))
        # checkpointed: a round must not carry the plans of the rounds before
        open_ = StateTable.build(ranges, checkpoint=True)
        done = []
        while open_.rows:
            held.append(open_)
            cut = open_.df.where((F.col("n") > SMALL_GROUP) & (F.col("lo") < F.col("hi")))
            done.append(open_.df.where((F.col("n") <= SMALL_GROUP) | (F.col("lo") >= F.col("hi"))))
            side = cut.select(*by, *[F.col(c).alias(f"_{c}") for c in ("lo", "hi", "flo", "fhi")], "_b")
            side = F.broadcast(side) if open_.broadcastable() else side
            cnt = (rows.join(side, by).where((v >= F.col("_lo")) & (v <= F.col("_hi")))
                   .groupBy(*by, F.col("_b").alias("_b0"), _bin(v, F.col("_flo"), F.col("_fhi")).alias("_k")).agg(*_range(v)))
            before = F.sum("n").over(Window.partitionBy(*by, "_b0").orderBy("_k")) - F.col("n") + F.col("_b0")
            nxt = cnt.withColumn("_b", before).join(want.side(), by).where(
                (F.col("_b") <= F.col("_r")) & (F.col("_r") < F.col("_b") + F.col("n")))
            open_ = StateTable.build(nxt.select(*by, "n", "lo", "hi", "flo", "fhi", "_b").distinct(), checkpoint=True)
        held.append(open_)
        small = stats.df.where(F.col("n") <= SMALL_GROUP).withColumn("_b", F.lit(0).cast("long"))
        leaf = small
        for d in done:
            leaf = leaf.unionByName(d)
        # ranges of one value need no rows
        one = leaf.where("lo = hi").select(*by, "_b", F.col("n").alias("_m"), F.array("lo").alias("_l"))
        side = leaf.where("lo < hi").select(*by, F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "_b")
        side = F.broadcast(side) if stats.broadcastable() else side
        lists = (rows.join(side, by).where((v >= F.col("_lo")) & (v <= F.col("_hi"))).groupBy(*by, "_b")
                 .agg(F.sort_array(F.collect_list("_v")).alias("_l")))
        got = lists.select(*by, "_b", F.size("_l").cast("long").alias("_m"), "_l").unionByName(one)
        whole = got.join(stats.df.select(*by, F.col("n").alias("_n")), by)
    at = (lambda r: F.max(F.when((F.col("_b") <= r) & (r < F.col("_b") + F.col("_m")), F.element_at(
        "_l", F.least(r - F.col("_b") + 1, F.size("_l")).cast("int")))))
    aggs = []
    for i, q in enumerate(probs):
        p = F.lit(float(q)) * (F.col("_n") - 1)
        lo = F.floor(p).cast("long")
        aggs += [at(lo).alias(f"_lo{i}"), at(F.least(lo + 1, F.col("_n") - 1)).alias(f"_hi{i}"), F.max(p - lo).alias(f"_f{i}")]
    g = whole.groupBy(*by).agg(*aggs)
    lo, hi = (lambda i: F.col(f"_lo{i}")), (lambda i: F.col(f"_hi{i}"))
    out = StateTable.build(g.select(*by, *[
        F.when(lo(i) == hi(i), lo(i)).otherwise(lo(i) + (hi(i) - lo(i)) * F.col(f"_f{i}")).alias(names[i])
        for i in range(len(probs))]))
    for h in held:
        h.df.unpersist()
    return out


def approx_quantiles(df: DataFrame, value_col: str, probs: list[float], accuracy: int = 100_000):
    """Scale option: bounded-memory sketch (`percentile_approx`)."""
    r = df.agg(F.percentile_approx(num(value_col), probs, accuracy).alias("q")).first()
    return list(r["q"]) if r["q"] is not None else [None for _ in probs]
