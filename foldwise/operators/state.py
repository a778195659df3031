"""State tables: small aggregated DataFrames joined back onto rows.

A state table is materialised once (persisted; lost blocks are recomputed
from lineage) and its row count is known. It is broadcast only
when that count is under `foldwise.broadcast.maxRows`; above it the join
shuffles on the key and AQE's skew-join splits hot keys.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

DEFAULT_BROADCAST_ROWS = 100_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _size_in_bytes(df: DataFrame) -> int | None:
    """Spark's own size statistic of a (materialised) plan, if available."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics are best effort
        return None


class StateTable:
    """A materialised, counted state table."""

    def __init__(self, df: DataFrame, rows: int, size: int | None = None):
        self.df = df
        self.rows = rows
        self.size = size

    @classmethod
    def build(cls, df: DataFrame, checkpoint: bool = False) -> "StateTable":
        """Materialise once. Persisted blocks lost with an executor are rebuilt
        from lineage; `checkpoint=True` writes to the shared checkpoint folder
        instead (iterative flows, long stage chains)."""
        mat = cut_lineage(df) if checkpoint else df.persist(StorageLevel.MEMORY_AND_DISK)
        rows = mat.count()
        return cls(mat, rows, _size_in_bytes(mat))

    def broadcastable(self) -> bool:
        """Both the row count and the measured size must be under the caps; an
        unknown size is not."""
        spark = self.df.sparkSession
        cap = int(spark.conf.get("foldwise.broadcast.maxRows", str(DEFAULT_BROADCAST_ROWS)))
        cap_b = int(spark.conf.get("foldwise.broadcast.maxBytes", str(DEFAULT_BROADCAST_BYTES)))
        return self.rows <= cap and self.size is not None and self.size <= cap_b

    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.broadcastable() else self.df


def attach(df: DataFrame, state: StateTable, on, how: str = "left") -> DataFrame:
    """Equi-join a state table onto rows. NULL keys never match (SQL
    equality), so those rows keep NULL state — same as a pandas merge that
    dropped NULL keys at fit time."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(state.side(), on=keys, how=how)


def lookup(df: DataFrame, state: StateTable, left_key: str, state_key: str,
           values: dict[str, tuple[str, object]]) -> DataFrame:
    """Map a column through a state table with per-output defaults.

    `values` maps output column → (state column, default literal or Column).
    """
    alias = f"__s_{left_key}"
    s = state.df.select(F.col(state_key).alias(alias), *[F.col(sc) for sc, _ in values.values()])
    st = F.broadcast(s) if state.broadcastable() else s
    joined = df.join(st, df[left_key] == st[alias], "left")
    outs = []
    for out, (sc, default) in values.items():
        d = default if hasattr(default, "_jc") else F.lit(default)
        outs.append(F.coalesce(st[sc], d).alias(out))
    return joined.select(*[df[c] for c in df.columns], *outs)
