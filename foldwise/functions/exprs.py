"""Column-expression helpers. Everything here is a built-in Spark SQL
expression, so it stays inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-6


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c) -> Column:
    """Numeric value as double with NaN normalised to NULL; text that is not a
    number becomes NULL instead of failing under ANSI mode."""
    x = col(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def flag(cond: Column) -> Column:
    """Boolean → 0/1 with NULL → 0 (comparisons on NULL never raise a flag)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_div(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def ts_micros(c) -> Column:
    """Microseconds since epoch for timestamp / timestamp_ntz / date / string."""
    return F.unix_micros(col(c).cast("timestamp"))


def ts_seconds(c) -> Column:
    return ts_micros(c) / F.lit(1_000_000.0)


def day_number(c, origin: str = "1970-01-01") -> Column:
    """Whole days since `origin` (time axis for splits)."""
    return F.datediff(col(c).cast("date"), F.to_date(F.lit(origin)))


def right_closed_bin(x, edges: list[float]) -> Column:
    """Index of the bin (e[i], e[i+1]] that holds x, first bin closed on the
    left; outside [e0, eN] or NULL → -1. Fewer than two edges → -1, except a
    constant column (one distinct edge) where the value itself is bin 0."""
    v = num(x)
    if len(edges) == 0:
        return F.lit(-1)
    if len(edges) == 1:
        return F.when(v == F.lit(float(edges[0])), F.lit(0)).otherwise(F.lit(-1))
    arr = F.array(*[F.lit(float(e)) for e in edges])
    inside = (v >= F.lit(float(edges[0]))) & (v <= F.lit(float(edges[-1])))
    idx = F.size(F.filter(arr, lambda e: e < v)) - 1
    return (F.when(v.isNull() | ~inside, F.lit(-1))
             .when(v == F.lit(float(edges[0])), F.lit(0))
             .otherwise(idx)).cast("int")


def corrected_skew(n: Column, g1: Column) -> Column:
    """Bias-corrected sample skewness from Spark's population `skewness`."""
    n = n.cast("double")
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurt(n: Column, g2: Column) -> Column:
    """Bias-corrected excess kurtosis from Spark's population `kurtosis`."""
    n = n.cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def md5_mod(s: Column, n: int) -> Column:
    """int(md5(s), 16) % n exactly: the 128-bit digest is split into two
    unsigned 64-bit halves and reduced with decimal arithmetic."""
    h = F.md5(s)
    hi = F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(20,0)")
    lo = F.conv(F.substring(h, 17, 16), 16, 10).cast("decimal(20,0)")
    two64 = (2 ** 64) % n
    return F.pmod(F.pmod(hi, F.lit(n)) * F.lit(two64) + F.pmod(lo, F.lit(n)), F.lit(n)).cast("int")


def hash_unit(c, seed: int = 42) -> Column:
    """Deterministic 32-bit unsigned hash of a value (md5 based, so identical
    in any engine that has md5) — used for shuffled fold assignment."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), col(c).cast("string"))), 1, 8), 16, 10).cast("bigint")


def dot(u, v) -> Column:
    return F.aggregate(F.zip_with(col(u), col(v), lambda a, b: a * b), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x)


def l2(u) -> Column:
    return F.sqrt(F.aggregate(F.transform(col(u), lambda a: a * a), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x))


def cosine(u, v, eps: float = EPS) -> Column:
    return dot(u, v) / (l2(u) * l2(v) + F.lit(eps))


def sq_dist(u, v) -> Column:
    return F.aggregate(F.zip_with(col(u), col(v), lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


TWO_PI = 2 * math.pi
