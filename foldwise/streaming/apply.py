"""K1: apply fitted stages to a streaming DataFrame.

Fitted state is either literals (the transform is a projection) or a static
state table (the transform is a stream-static left join), so the same
`Fitted.transform` works on a streaming source. Stages that need rows from
other events (rolling windows, neighbours) are rejected: on a stream they
would need stateful operators with their own semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.groups import RollingStats
from ..operators.neighbors import NearestNeighborFeatures
from ..operators.text import CountVectorizer, WordVectorPool
from ..session import scratch_path

# these read other rows, or aggregate a row's terms
NOT_STREAMABLE = (RollingStats, NearestNeighborFeatures, CountVectorizer, WordVectorPool)


def apply_stream(stream: DataFrame, fitted: list) -> DataFrame:
    """Chain fitted stages over a streaming DataFrame (lazy)."""
    out = stream
    for f in fitted:
        if isinstance(f.stage, NOT_STREAMABLE):
            raise ValueError(f"{f.stage!r} cannot run on a stream: it reads other rows of the stream")
        out = f.transform(out)
    return out


def run_to_table(stream: DataFrame, query_name: str, checkpoint: str, trigger_available_now: bool = True):
    """Drive a streaming plan to completion into Parquet files under the shared
    checkpoint folder and return them as a batch DataFrame."""
    spark = stream.sparkSession
    path = scratch_path(spark, query_name)
    w = (stream.writeStream.format("parquet").queryName(query_name).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    q = w.trigger(availableNow=True).start() if trigger_available_now else w.start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
