"""Dense 0-based row index in a global order, without a single-partition
window: rows are range-partitioned and sorted, and each partition's offset
comes from the per-partition counts (one row per partition)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_index(df: DataFrame, order, out: str = "idx") -> DataFrame:
    """Add `out` = position of each row in `order` (0-based).

    The sorted table is checkpointed to the shared checkpoint folder so the
    counts and the indexed rows come from the same partitioning, also after
    an executor is lost."""
    order = list(order)
    srt = (df.repartitionByRange(*order).sortWithinPartitions(*order)
             .withColumn("__p", F.spark_partition_id())
             .withColumn("__m", F.monotonically_increasing_id()))
    srt = cut_lineage(srt)
    parts = sorted((r["__p"], r["c"], r["m0"]) for r in
                   srt.groupBy("__p").agg(F.count(F.lit(1)).alias("c"), F.min("__m").alias("m0")).collect())
    shift, off = [], 0
    for p, c, m0 in parts:
        shift.append((p, off - m0))
        off += c
    if not shift:
        return srt.drop("__p", "__m").withColumn(out, F.lit(None).cast("long"))
    # one row a partition: a broadcast of known size
    offsets = df.sparkSession.createDataFrame(shift, "__p int, __s long")
    return (srt.join(F.broadcast(offsets), "__p").withColumn(out, F.col("__m") + F.col("__s"))
            .drop("__p", "__m", "__s"))
