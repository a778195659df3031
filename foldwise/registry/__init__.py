"""Check-query registry: every operator gets a Spark query over the test
tables and (where SQL can express it) the equivalent DuckDB SQL.

Output hygiene for the side-by-side comparison: doubles are rounded to 6
digits (4 for variance-like values) on both sides, integers are cast to
BIGINT, and every computed column is aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = portable_round(sql.strip())
        return fn

    return deco


def portable_round(sql: str) -> str:
    """Rewrite `round(expr, d)` as `floor(expr * 1ed + 0.5) / 1ed`: the same
    IEEE operations as `tidy` performs in Spark, so ties are broken the same
    way in both engines (their built-in `round`s differ on ties)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        expr = portable_round(sql[j + 6:comma])
        d = int(sql[comma + 1:k].strip())
        out.append(sql[i:j])
        out.append(f"(floor(({expr}) * 1e{d} + 0.5) / 1e{d})")
        i = k + 1


def tidy(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round doubles, widen integers to BIGINT (same on the SQL side)."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(round_half_up(c.cast("double"), overrides.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType, T.BooleanType)):
            out.append(c.cast("bigint").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def round_half_up(c, d: int):
    """floor(x * 10^d + 0.5) / 10^d in plain double arithmetic (see
    `portable_round`)."""
    scale = float(10 ** d)
    return (F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def load_all() -> None:
    """Import every registry module (registration is an import side effect)."""
    import importlib

    for mod in ("groups_q", "features_num", "features_cat", "features_time", "features_text",
                "metrics_q", "splits_q", "relational_q", "learned_q", "flows_q"):
        importlib.import_module(f"{__name__}.{mod}")
