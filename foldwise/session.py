"""Spark session and lineage helpers shared by every stage and flow."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job in the library relies on. Cluster deployments pass their
# own values through spark-submit; `builder` only fills what is missing.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "foldwise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("FOLDWISE_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared `spark.checkpoint.dir`. Where it is unset a local
    run gets a fresh scratch folder; on a cluster that is an error, as executors
    don't share local folders."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="foldwise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package() -> None:
    """Send this package's functions to Python workers by value, so that jobs
    also run where the workers can't import it (another working directory, a
    cluster without the package installed)."""
    import foldwise
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(foldwise)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return f"{base.rstrip('/')}/foldwise-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared storage) — survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: lineage is cut and
    no executor holds the only copy. The shuffle files behind it are deleted
    when the write ends, so read the result, not `df`, from then on."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(cleanup, "false")
    conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(cleanup, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a frame made by `stored`, once nothing reads it."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm, hadoop = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(hadoop).delete(p, True)


# bytes of input files that one task of CPU-heavy work should have at most
SPREAD_BYTES = 16 * 1024 * 1024
# Spark's size statistic of a plan it knows nothing of is far above this
UNKNOWN_BYTES = 1 << 60


def spread(df: DataFrame, always: bool = True, rows: int | None = None) -> DataFrame:
    """Deal the rows of a scan evenly when CPU-heavy per-row work follows, over
    the cluster's default parallelism or more tasks on larger files, so that a
    task's share is bounded. The number of splits tells little: a row group is
    read by one task whatever its size, and the splits without one are empty.
    Many splits are dealt by seeded random numbers, as a round robin would sort
    their rows first. `always=False` leaves files alone that give each core
    `SPREAD_BYTES` at most. `rows` bounds a task's rows as well, where texts may
    be many times larger than their compressed files; they are counted from the
    file footers. A plan that already shuffles is left alone."""
    if df.isStreaming:
        return df
    plan = df._jdf.queryExecution().optimizedPlan()
    if re.search(r"\b(Aggregate|Join|Window|Sort|Repartition\w*|Distinct|Deduplicate|Rebalance\w*|InMemoryRelation)\b",
                 plan.toString()):
        return df
    target = df.sparkSession.sparkContext.defaultParallelism
    leaves = plan.collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    known = size < UNKNOWN_BYTES  # not the rows of an RDD, such as a checkpoint
    if not always and not (known and size > target * SPREAD_BYTES):
        return df
    tasks = max(target, -(-df.count() // rows)) if rows and known else target
    if df.rdd.getNumPartitions() < target and always and tasks == target:
        return df.repartition(target)
    return df.repartition(max(tasks, -(-size // SPREAD_BYTES)), F.rand(42)) if known else df
