"""Per-group ordering: top-k (A9) and running sums / positions (A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def group_sort_topk(df: DataFrame, by, score: str, k: int, tie: str | None = None,
                    rank_col: str = "rank") -> DataFrame:
    """The k best rows of each group by descending score (ties by `tie`).

    `row_number() <= k` is planned with a partial WindowGroupLimit before the
    shuffle, so each task ships at most k rows per group — a hot group does not
    move its full row set."""
    order = [F.col(score).desc()] + ([F.col(tie).asc()] if tie else [])
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def running_hits(df: DataFrame, by, score: str, rel: str, tie: str,
                 hits_col: str = "hits", pos_col: str = "pos") -> DataFrame:
    """A10: within each group ordered by descending score (then `tie`), the
    running sum of `rel` and the 1-based position.

    A plain window would stream a whole group through one task. Here rows are
    range-partitioned on (group, -score, tie) so a hot group spans many tasks;
    each task computes local running values per (group, task) and adds the
    offset of the preceding tasks' totals for that group (a small table)."""
    by = list(by)
    keys = [*by, F.col(score).desc(), F.col(tie).asc()]
    # checkpointed: the task ids below must be the same in both branches
    # (local sums and per-task totals); nothing stays cached
    srt = cut_lineage(df.repartitionByRange(*keys).withColumn("__p", F.spark_partition_id()))
    local_w = Window.partitionBy(*by, "__p").orderBy(F.col(score).desc(), F.col(tie).asc())
    local = (srt.withColumn("__h", F.sum(F.col(rel)).over(local_w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("__n", F.row_number().over(local_w)))
    tot = local.groupBy(*by, "__p").agg(F.sum(F.col(rel)).alias("__th"), F.count(F.lit(1)).alias("__tn"))
    ow = Window.partitionBy(*by).orderBy("__p")
    offs = (tot.withColumn("__oh", F.coalesce(F.sum("__th").over(ow) - F.col("__th"), F.lit(0)))
               .withColumn("__on", F.sum("__tn").over(ow) - F.col("__tn"))
               .select(*by, "__p", "__oh", "__on"))
    # AQE broadcasts `offs` (one row per task and group) when its runtime
    # size is under the broadcast threshold
    out = local.join(offs, on=[*by, "__p"], how="left")
    return (out.withColumn(hits_col, F.col("__h") + F.col("__oh"))
               .withColumn(pos_col, F.col("__n") + F.col("__on"))
               .drop("__p", "__h", "__n", "__oh", "__on"))


def running_totals(df: DataFrame, by, order, values: dict) -> DataFrame:
    """Inclusive running sums of `values` (name → column) within each group
    of `by`, in `order` (a list of sort expressions that makes rows unique).

    Same distributed scheme as `running_hits`: range partitioning spreads a
    hot (or the single, when `by` is empty) group over many tasks; per-task
    local sums are shifted by the totals of the preceding tasks."""
    by = list(by)
    srt = cut_lineage(df.repartitionByRange(*[F.col(b) for b in by], *order).withColumn("__p", F.spark_partition_id()))
    local_w = Window.partitionBy(*by, "__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = srt.select("*", *[F.sum(v).over(local_w).alias(f"__l_{k}") for k, v in values.items()])
    tot = local.groupBy(*by, "__p").agg(*[F.sum(v).alias(f"__t_{k}") for k, v in values.items()])
    ow = Window.partitionBy(*by).orderBy("__p")
    offs = tot.select(*by, "__p", *[
        F.coalesce(F.sum(f"__t_{k}").over(ow) - F.col(f"__t_{k}"), F.lit(0)).alias(f"__o_{k}") for k in values])
    out = local.join(offs, on=[*by, "__p"], how="left")
    return out.select(*[c for c in df.columns],
                      *[(F.col(f"__l_{k}") + F.coalesce(F.col(f"__o_{k}"), F.lit(0))).alias(k) for k in values])
