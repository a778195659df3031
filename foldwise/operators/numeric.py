"""Numerical feature stages.

Every fit is one aggregate pass over all configured columns (or a sort for
exact quantiles); transforms are pure column expressions in one `select`.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import EPS, flag, num, right_closed_bin
from ..session import spread
from .base import AggregateFit, Fitted, LiteralFitted, StatelessStage, Stage, require_columns
from .quantiles import approx_quantiles, column_quantiles
from .ranking import running_totals
from .state import StateTable, lookup


MAX_CLASSES = 100  # of a tree binner's target


def _linspace(lo: float, hi: float, n: int) -> list[float]:
    """Evenly spaced edges: e_i = i*step + lo, last edge pinned to hi."""
    step = (hi - lo) / n
    edges = [i * step + lo for i in range(n + 1)]
    edges[-1] = hi
    return edges


def _add(df: DataFrame, cols: dict) -> DataFrame:
    """Add (or replace) several columns in one projection."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*keep, *[e.alias(n) for n, e in cols.items()])


# ------------------------------------------------------------------ binning
class _Binner(Stage):
    suffix = ""

    def __init__(self, name: str, cols, n_bins: int = 10):
        super().__init__(name)
        self.cols, self.n_bins = list(cols), int(n_bins)

    def _bounds_aggs(self, prefix: str) -> list:
        return [e for c in self.cols for e in (F.min(num(c)).alias(f"{prefix}{c}__lo"),
                                               F.max(num(c)).alias(f"{prefix}{c}__hi"))]

    def _bounds_edges(self, r, prefix: str) -> dict:
        out = {}
        for c in self.cols:
            lo, hi = r[f"{prefix}{c}__lo"], r[f"{prefix}{c}__hi"]
            out[c] = [] if lo is None else _linspace(lo, hi, self.n_bins)
        return out

    def _edges(self, df: DataFrame) -> dict:
        return self._bounds_edges(df.agg(*self._bounds_aggs("")).first(), "")

    def _fitted(self, edges: dict) -> Fitted:
        return LiteralFitted(self, edges, lambda d, st: _add(
            d, {f"{c}_{self.suffix}": right_closed_bin(c, st[c]) for c in self.cols}))

    def fit(self, df: DataFrame) -> Fitted:
        require_columns(df, self.cols, self.name)
        return self._fitted(self._edges(df))


class EqualWidthBinner(AggregateFit, _Binner):
    """`<c>_ew_binned`; edges evenly spaced between the fitted min and max."""

    suffix = "ew_binned"

    def fit_inputs(self):
        return self.cols

    def fit_aggs(self, prefix):
        return self._bounds_aggs(prefix)

    def from_row(self, row, prefix):
        return self._fitted(self._bounds_edges(row, prefix))


class QuantileBinner(_Binner):
    """`<c>_q_binned`; edges at the k/n quantiles, duplicates dropped.
    `approx=True` uses a bounded-memory sketch instead of exact ranks."""

    suffix = "q_binned"

    def __init__(self, name: str, cols, n_bins: int = 10, approx: bool = False):
        super().__init__(name, cols, n_bins)
        self.approx = approx

    def _edges(self, df: DataFrame) -> dict:
        probs = [k / self.n_bins for k in range(self.n_bins + 1)]
        if self.approx:
            got = {c: approx_quantiles(df, c, probs) for c in self.cols}
        else:
            got = column_quantiles(df, dict.fromkeys(self.cols, probs))
        return {c: sorted({q for q in got[c] if q is not None}) for c in self.cols}


class DecisionTreeBinner(_Binner):
    """`<c>_tree_binned`; edges = min, max and the split thresholds of a
    depth-limited classification tree on that column alone.

    The splits are exact: every distinct value is a candidate, however many there
    are. Running class counts over the distinct values are made once; a node is
    a range of values, so what lies left of a candidate in its node is a
    difference of integer counts. A level is one aggregate for all nodes of all
    columns, which takes the candidate with the smallest Gini impurity (of equal
    ones the smallest value); pure nodes stop. A threshold is half-way to the
    next value in the node."""

    suffix = "tree_binned"

    def __init__(self, name: str, cols, target_col: str, max_depth: int = 3):
        super().__init__(name, cols)
        self.target_col, self.max_depth = target_col, max_depth

    def _edges(self, df: DataFrame) -> dict:
        require_columns(df, self.cols + [self.target_col], self.name)
        bounds = _Binner._edges(self, df)
        label = F.col(self.target_col)
        classes = [r[0] for r in df.select(label).where(label.isNotNull()).distinct().orderBy(label).limit(MAX_CLASSES + 1).collect()]
        if len(classes) > MAX_CLASSES:
            raise ValueError(f"{self.name}: target {self.target_col!r} has more than {MAX_CLASSES} classes")
        k = len(classes)
        val = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), num(c).alias("v")) for i, c in enumerate(self.cols)]))
        counts = (df.where(label.isNotNull()).select(label.alias("y"), val.alias("x")).where("x.v is not null")
                  .groupBy("x.c", "x.v").agg(*[F.count_if(F.col("y") == F.lit(y)).alias(f"n{j}") for j, y in enumerate(classes)]))
        if not k:
            return {c: sorted({e[0], e[-1]}) if (e := bounds[c]) else [] for c in self.cols}
        cum = running_totals(counts, ["c"], [F.col("v").asc()], {f"s{j}": F.col(f"n{j}") for j in range(k)})
        kept = StateTable.build(cum.select("c", "v", *[f"s{j}" for j in range(k)]))
        cum = kept.df
        top = cum.groupBy("c").agg(F.max("v").alias("hi"), *[F.max(f"s{j}").alias(f"s{j}") for j in range(k)]).collect()
        # (column, below, above, counts up to below, counts up to above)
        nodes = [(r["c"], None, r["hi"], [0] * k, [r[f"s{j}"] for j in range(k)]) for r in top]
        cuts: dict = {c: set() for c in self.cols}
        for _ in range(self.max_depth):
            nodes = [n for n in nodes if sum(1 for a, b in zip(n[3], n[4]) if b > a) > 1]  # not pure
            if not nodes:
                break
            found = self._best_splits(cum, nodes, k)
            grown = []
            for i, (v, left, nxt) in found.items():
                c, lo, hi, base, full = nodes[i]
                half = v / 2 + nxt / 2
                cuts[self.cols[c]].add(half if half < nxt else v)
                grown += [(c, lo, v, base, left), (c, v, hi, left, full)]
            nodes = grown
        cum.unpersist()
        return {c: sorted(cuts[c] | ({bounds[c][0], bounds[c][-1]} if bounds[c] else set())) for c in self.cols}

    @staticmethod
    def _best_splits(cum: DataFrame, nodes: list, k: int) -> dict:
        """node → (last value on the left, class counts up to it, next value)."""
        v = F.col("v")
        where = None
        for i, (c, lo, hi, base, full) in enumerate(nodes):
            inside = (F.col("c") == c) & (v <= F.lit(hi)) & ((v > F.lit(lo)) if lo is not None else F.lit(True))
            hit = F.struct(F.lit(i).alias("i"), F.lit(hi).alias("hi"), F.array(*map(F.lit, base)).alias("base"),
                           F.array(*map(F.lit, full)).alias("full"))
            where = F.when(inside, hit) if where is None else where.when(inside, hit)
        cand = cum.withColumn("x", where).where("x is not null")
        left = [F.col(f"s{j}") - F.col("x.base")[j] for j in range(k)]
        right = [F.col("x.full")[j] - F.col(f"s{j}") for j in range(k)]

        def purity(part):
            square = [(x * x).cast("double") for x in part]
            return sum(square[1:], square[0]) / sum(part[1:], part[0]).cast("double")

        cand = cand.select("v", *[f"s{j}" for j in range(k)], F.struct(
            "x.i", F.when(v < F.col("x.hi"), purity(left) + purity(right)).alias("gain")).alias("x"))
        best = cand.where("x.gain is not null").groupBy("x.i").agg(
            F.max_by(F.struct("v", *[f"s{j}" for j in range(k)]), F.struct(F.col("x.gain"), -v)).alias("b")).collect()
        at = {r["i"]: r["b"] for r in best}
        if not at:
            return {}
        after = None
        for i, b in at.items():
            test = (F.col("x.i") == i) & (v > F.lit(b["v"]))
            after = test if after is None else after | test
        nxt = {r["i"]: r["v"] for r in cand.where(after).groupBy("x.i").agg(F.min("v").alias("v")).collect()}
        return {i: (b["v"], [b[f"s{j}"] for j in range(k)], nxt[i]) for i, b in at.items()}


# ------------------------------------------------------------------ flags
class ValueIndicator(StatelessStage):
    """`<c>_is_<v>` (a minus sign in v becomes `neg`); NULL → 0."""

    def __init__(self, name: str, cols, value=0):
        super().__init__(name)
        self.cols, self.value = list(cols), value

    def apply(self, df):
        tag = str(self.value).replace("-", "neg")
        numeric = isinstance(self.value, (int, float)) and not isinstance(self.value, bool)
        # numeric values compare numerically (text that is not a number → no flag)
        lhs = (lambda c: num(c)) if numeric else (lambda c: F.col(c))
        return _add(df, {f"{c}_is_{tag}": flag(lhs(c) == F.lit(self.value)) for c in self.cols})


class IsNullIndicator(StatelessStage):
    """`<c>_is_null` (NaN counts as null)."""

    def __init__(self, name: str, cols):
        super().__init__(name)
        self.cols = list(cols)

    def apply(self, df):
        def isnull(c):
            dt = dict(df.dtypes)[c]
            if dt in ("double", "float"):
                return (F.col(c).isNull() | F.isnan(c)).cast("int")
            return F.col(c).isNull().cast("int")

        return _add(df, {f"{c}_is_null": isnull(c) for c in self.cols})


class OutlierIndicator(Stage):
    """`<c>_is_outlier` outside [Q1 − m·IQR, Q3 + m·IQR]; NULL → 0."""

    def __init__(self, name: str, cols, multiplier: float = 1.5):
        super().__init__(name)
        self.cols, self.multiplier = list(cols), float(multiplier)

    def fit(self, df):
        st = {}
        for c, (q1, q3) in column_quantiles(df, dict.fromkeys(self.cols, [0.25, 0.75])).items():
            iqr = None if q1 is None else q3 - q1  # a column without values flags nothing
            st[c] = (None, None) if iqr is None else (q1 - self.multiplier * iqr, q3 + self.multiplier * iqr)
        return LiteralFitted(self, st, lambda d, s: _add(d, {
            f"{c}_is_outlier": flag((num(c) < F.lit(s[c][0]).cast("double")) | (num(c) > F.lit(s[c][1]).cast("double")))
            for c in self.cols}))


# ------------------------------------------------------------------ scalers
class StandardScaler(AggregateFit, Stage):
    """`(x - mean) / std` with population std; zero std divides by 1."""

    def __init__(self, name: str, cols, with_mean: bool = True, with_std: bool = True):
        super().__init__(name)
        self.cols, self.with_mean, self.with_std = list(cols), with_mean, with_std

    def fit_inputs(self):
        return self.cols

    def fit_aggs(self, prefix):
        return [e for c in self.cols for e in (F.avg(num(c)).alias(f"{prefix}{c}__m"),
                                               F.stddev_pop(num(c)).alias(f"{prefix}{c}__s"))]

    def from_row(self, r, prefix):
        st = {}
        for c in self.cols:
            m, s = r[f"{prefix}{c}__m"], r[f"{prefix}{c}__s"]
            st[c] = (m if self.with_mean else 0.0, (s if s else 1.0) if self.with_std else 1.0)

        def build(d, s):
            return _add(d, {f"{c}_standard_scaled": (num(c) - F.lit(s[c][0])) / F.lit(s[c][1]) for c in self.cols})

        return LiteralFitted(self, st, build)


class MinMaxScaler(AggregateFit, Stage):
    """To `feature_range`; a constant column maps to the low end."""

    def __init__(self, name: str, cols, feature_range=(0.0, 1.0)):
        super().__init__(name)
        self.cols, self.feature_range = list(cols), tuple(float(x) for x in feature_range)

    def fit_inputs(self):
        return self.cols

    def fit_aggs(self, prefix):
        return [e for c in self.cols for e in (F.min(num(c)).alias(f"{prefix}{c}__lo"),
                                               F.max(num(c)).alias(f"{prefix}{c}__hi"))]

    def from_row(self, r, prefix):
        lo_t, hi_t = self.feature_range
        st = {}
        for c in self.cols:
            lo, hi = r[f"{prefix}{c}__lo"], r[f"{prefix}{c}__hi"]
            rng = (hi - lo) if lo is not None else 1.0
            scale = (hi_t - lo_t) / (rng if rng != 0 else 1.0)
            st[c] = (scale, lo_t - (lo if lo is not None else 0.0) * scale)

        def build(d, s):
            return _add(d, {f"{c}_minmax_scaled": num(c) * F.lit(s[c][0]) + F.lit(s[c][1]) for c in self.cols})

        return LiteralFitted(self, st, build)


class RobustScaler(Stage):
    """`(x - median) / (q_hi - q_lo)`; a zero range divides by 1."""

    def __init__(self, name: str, cols, quantile_range=(25.0, 75.0), with_centering=True, with_scaling=True,
                 approx: bool = False):
        super().__init__(name)
        self.cols = list(cols)
        self.q = tuple(float(x) / 100.0 for x in quantile_range)
        self.with_centering, self.with_scaling, self.approx = with_centering, with_scaling, approx

    def fit(self, df):
        require_columns(df, self.cols, self.name)
        st, probs = {}, [self.q[0], 0.5, self.q[1]]
        if self.approx:
            got = {c: approx_quantiles(df, c, probs) for c in self.cols}
        else:
            got = column_quantiles(df, dict.fromkeys(self.cols, probs))
        for c, (lo, med, hi) in got.items():
            if med is None:  # no values, nothing to scale
                lo = med = hi = 0.0
            rng = hi - lo
            st[c] = (med if self.with_centering else 0.0,
                     (rng if rng != 0 else 1.0) if self.with_scaling else 1.0)

        def build(d, s):
            return _add(d, {f"{c}_robust_scaled": (num(c) - F.lit(s[c][0])) / F.lit(s[c][1]) for c in self.cols})

        return LiteralFitted(self, st, build)


# ------------------------------------------------------------------ transforms
class LogTransformer(StatelessStage):
    """`<c>_log1p`; x ≤ -1 gives NULL."""

    def __init__(self, name: str, cols):
        super().__init__(name)
        self.cols = list(cols)

    def apply(self, df):
        return _add(df, {f"{c}_log1p": F.log1p(num(c)) for c in self.cols})


class SqrtTransformer(StatelessStage):
    """`<c>_sqrt` = sqrt(max(x, 0)); NULL stays NULL."""

    def __init__(self, name: str, cols):
        super().__init__(name)
        self.cols = list(cols)

    def apply(self, df):
        return _add(df, {f"{c}_sqrt": F.when(num(c).isNotNull(), F.sqrt(F.greatest(num(c), F.lit(0.0))))
                         for c in self.cols})


def box_cox_expr(x, lam):
    """(x^λ − 1)/λ, ln x at λ = 0; λ may be a float or a Column."""
    if not hasattr(lam, "_jc"):
        return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / F.lit(lam)
    return F.when(lam == 0, F.log(x)).otherwise((F.pow(x, lam) - 1) / lam)


def yeo_johnson_expr(x, lam):
    if not hasattr(lam, "_jc"):
        lam = F.lit(float(lam))
    pos = F.when(lam == 0, F.log(x + 1)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    neg = F.when(lam == 2, -F.log(-x + 1)).otherwise(-(F.pow(-x + 1, 2 - lam) - 1) / (2 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


START = (-2.0, 0.0, 2.0)  # values of λ that are looked at first
MAX_LAMBDA = 1e4  # the search goes on to here when the best λ is beyond them
SMALL_Z, TERMS = 0.05, 7  # below it, series instead of quotients


def _power_series(z, order: int):
    """d^order/dz^order of (e^z − 1)/z near 0: Σ z^k (k+1)…(k+order) / (k+order+1)!"""
    total = F.lit(0.0)
    for k in range(TERMS, -1, -1):  # Horner
        total = total * z + F.lit(math.prod(range(k + 1, k + order + 1)) / math.factorial(k + order + 1))
    return total


class _PowerTransformer(Stage):
    """λ by maximum likelihood of the profile log-likelihood
    llf(λ) = (λ − 1)·J − n/2·ln var(T_λ(x)).

    One aggregate a step for all columns: variance and covariances of T and its
    derivatives by λ give the slope and curvature of llf. The slope's signs at a
    few values of λ bracket the maximum; Newton steps, halved intervals where
    they would leave the bracket, close in on it. No rows are multiplied. λ is
    rounded to `digits` decimals."""

    suffix = ""

    def __init__(self, name: str, cols, digits: int = 4):
        super().__init__(name)
        self.cols, self.digits = list(cols), int(digits)

    def _expr(self, x, lam):  # pragma: no cover - abstract
        raise NotImplementedError

    def _log(self, x, shift: float):  # pragma: no cover - abstract
        """u and whether x is mirrored: T = (e^{λu} − 1)/λ, for mirrored x the
        negative of the same with 2 − λ."""
        raise NotImplementedError

    def _first(self, df) -> dict:  # pragma: no cover - abstract
        """column → (n, J, shift) in one aggregate."""
        raise NotImplementedError

    def _look(self, df, first: dict, at: dict, curved: bool) -> dict:
        """(column, λ) → (slope, curvature) of llf / n; None where the variance
        is not positive or not finite."""
        keys = [(c, lam) for c, lams in at.items() for lam in lams]
        order = {c: j for j, c in enumerate(at)}
        logs = [(f"u{j}", f"m{j}", *self._log(num(c), first[c][2])) for c, j in order.items()]
        # one projection a step, so that nothing is computed twice
        d = df.select(*[e for u, m, x, y in logs for e in (x.alias(u), y.alias(m))])
        d = d.select("*", *[(F.col(f"u{order[c]}") * F.when(F.col(f"m{order[c]}"), F.lit(2.0 - lam)).otherwise(lam)).alias(f"z{i}")
                            for i, (c, lam) in enumerate(keys)])
        d = d.select("*", *[F.exp(f"z{i}").alias(f"e{i}") for i in range(len(keys))])
        cols = []
        for i, (c, _) in enumerate(keys):
            u, z, e = F.col(f"u{order[c]}"), F.col(f"z{i}"), F.col(f"e{i}")
            near, sign = F.abs(z) < F.lit(SMALL_Z), F.when(F.col(f"m{order[c]}"), F.lit(-1.0)).otherwise(1.0)
            cols += [(sign * u * F.when(near, _power_series(z, 0)).otherwise((e - 1) / z)).alias(f"t{i}"),
                     (u * u * F.when(near, _power_series(z, 1)).otherwise((e * (z - 1) + 1) / (z * z))).alias(f"p{i}")]
            if curved:
                cols.append((sign * u * u * u * F.when(near, _power_series(z, 2)).otherwise(
                    (e * (z * z - z * 2 + 2) - 2) / (z * z * z))).alias(f"q{i}"))
        aggs = []
        for i in range(len(keys)):
            aggs += [F.var_pop(f"t{i}").alias(f"v{i}"), F.covar_pop(f"t{i}", f"p{i}").alias(f"a{i}")]
            if curved:
                aggs += [F.var_pop(f"p{i}").alias(f"b{i}"), F.covar_pop(f"t{i}", f"q{i}").alias(f"d{i}")]
        r = d.select(*cols).agg(*aggs).first()
        out = {}
        for i, (c, lam) in enumerate(keys):
            n, j, _ = first[c]
            v, a = r[f"v{i}"], r[f"a{i}"]
            if v is None or not v > 0 or not math.isfinite(v) or not math.isfinite(a):
                out[c, lam] = None
                continue
            bend = -((r[f"b{i}"] + r[f"d{i}"]) / v - 2 * (a / v) ** 2) if curved else None
            out[c, lam] = (j / n - a / v, bend)
        return out

    def _search(self, df) -> dict:
        first = self._first(df)
        lams: dict = {c: None for c in self.cols}
        seen = self._look(df, first, {c: START for c in self.cols if first[c][0]}, False) if any(
            first[c][0] for c in self.cols) else {}
        live: dict = {}  # column → [below, above, next λ]
        for c in self.cols:
            slopes = [(lam, s[0]) for lam in START if (s := seen.get((c, lam)))]
            if not slopes:
                continue
            up = [lam for lam, s in slopes if s > 0]
            down = [lam for lam, s in slopes if s <= 0]
            live[c] = [max(up) if up else None, min([x for x in down if not up or x > max(up)], default=None), None]
        # beyond the first values: twice as far each time
        while open_ := {c: b for c, b in live.items() if b[0] is None or b[1] is None}:
            at = {c: [b[0] + max(abs(b[0]), 1.0) if b[1] is None else b[1] - max(abs(b[1]), 1.0)] for c, b in open_.items()}
            got = self._look(df, first, at, False)
            for c, (lam,) in at.items():
                s, b = got[c, lam], live[c]
                upward = b[1] is None
                if s is None or abs(lam) > MAX_LAMBDA:  # no further: the last finite value
                    lams[c] = b[0] if upward else b[1]
                    del live[c]
                else:
                    live[c][0 if s[0] > 0 else 1] = lam
        for b in live.values():
            b[2] = (b[0] + b[1]) / 2
        for _ in range(60):
            if not live:
                break
            got = self._look(df, first, {c: [b[2]] for c, b in live.items()}, True)
            for c, b in list(live.items()):
                s, lam = got[c, b[2]], b[2]
                if s is None:
                    b[1] = lam
                    b[2] = (b[0] + b[1]) / 2
                    continue
                b[0 if s[0] > 0 else 1] = lam
                step = lam - s[0] / s[1] if s[1] < 0 else None
                done = 10.0 ** -(self.digits + 3)
                if step is not None and b[0] < step < b[1]:
                    if abs(step - lam) < done:
                        lams[c] = step
                        del live[c]
                        continue
                    b[2] = step
                elif b[1] - b[0] < done or s[0] == 0:
                    lams[c] = lam
                    del live[c]
                else:
                    b[2] = (b[0] + b[1]) / 2
        for c, b in live.items():
            lams[c] = b[2]
        return {c: None if lam is None else round(lam, self.digits) for c, lam in lams.items()}

    def fit(self, df):
        require_columns(df, self.cols, self.name)
        lams = self._search(spread(df.select(*self.cols)))
        return LiteralFitted(self, lams, lambda d, s: _add(
            d, {f"{c}_{self.suffix}": self._expr(num(c), s[c]) for c in self.cols}))


class BoxCoxTransformer(_PowerTransformer):
    """`<c>_boxcox`; the fit fails when any value is ≤ 0. The search runs on
    x over its geometric mean, for which J is 0."""

    suffix = "boxcox"

    def _expr(self, x, lam):
        return box_cox_expr(x, lam)

    def _log(self, x, shift):
        return F.log(x) - F.lit(shift), F.lit(False)

    def _first(self, df):
        r = df.agg(*[e for i, c in enumerate(self.cols) for e in (
            F.count_if(num(c) <= 0).alias(f"bad{i}"), F.count(num(c)).alias(f"n{i}"),
            F.avg(F.when(num(c) > 0, F.log(num(c)))).alias(f"m{i}"))]).first()
        for i, c in enumerate(self.cols):
            if r[f"bad{i}"]:
                raise ValueError(f"{self.name}: column {c!r} has non-positive values; Box-Cox needs x > 0")
        return {c: (r[f"n{i}"], 0.0, r[f"m{i}"] or 0.0) for i, c in enumerate(self.cols)}


class YeoJohnsonTransformer(_PowerTransformer):
    """`<c>_yeojohnson`; defined for any sign."""

    suffix = "yeojohnson"

    def _expr(self, x, lam):
        return yeo_johnson_expr(x, lam)

    def _log(self, x, shift):
        return F.log1p(F.abs(x)), F.coalesce(x < 0, F.lit(False))

    def _first(self, df):
        r = df.agg(*[e for i, c in enumerate(self.cols) for e in (
            F.count(num(c)).alias(f"n{i}"), F.sum(F.signum(num(c)) * F.log1p(F.abs(num(c)))).alias(f"j{i}"))]).first()
        return {c: (r[f"n{i}"], r[f"j{i}"] or 0.0, 0.0) for i, c in enumerate(self.cols)}


# ------------------------------------------------------------------ interactions
class NumericalInteraction(StatelessStage):
    """For each column pair (a, b): a_add_b, a_sub_b, b_sub_a, a_mul_b,
    a_div_b = a/(b+1e-6), b_div_a."""

    OPS = ("add", "subtract", "multiply", "divide")

    def __init__(self, name: str, cols, operations=OPS):
        super().__init__(name)
        if len(cols) < 2:
            raise ValueError("NumericalInteraction needs at least two columns")
        self.cols, self.operations = list(cols), list(operations)

    def apply(self, df):
        require_columns(df, self.cols, self.name)
        out = {}
        for a, b in combinations(self.cols, 2):
            x, y = num(a), num(b)
            if "add" in self.operations:
                out[f"{a}_add_{b}"] = x + y
            if "subtract" in self.operations:
                out[f"{a}_sub_{b}"] = x - y
                out[f"{b}_sub_{a}"] = y - x
            if "multiply" in self.operations:
                out[f"{a}_mul_{b}"] = x * y
            if "divide" in self.operations:
                out[f"{a}_div_{b}"] = F.try_divide(x, y + F.lit(EPS))
                out[f"{b}_div_{a}"] = F.try_divide(y, x + F.lit(EPS))
        return _add(df, out)


class NumCatInteraction(Stage):
    """Deviation from the group mean: `<x>_div_by_<cat>_mean` =
    x/(group_mean+1e-6) and `<x>_sub_by_<cat>_mean` = x − group_mean; unseen or
    NULL groups fall back to the overall mean of x."""

    def __init__(self, name: str, interactions: dict):
        super().__init__(name)
        self.interactions = {k: list(v) for k, v in interactions.items()}

    def fit(self, df):
        cols = list(self.interactions) + [x for v in self.interactions.values() for x in v]
        require_columns(df, cols, self.name)
        allx = sorted({x for v in self.interactions.values() for x in v})
        overall = df.agg(*[F.avg(num(x)).alias(x) for x in allx]).first().asDict()
        states = {}
        for cat, xs in self.interactions.items():
            g = (df.where(F.col(cat).isNotNull()).groupBy(cat)
                   .agg(*[F.avg(num(x)).alias(f"__gm_{x}") for x in xs]))
            states[cat] = StateTable.build(g)
        return _NumCatFitted(self, states, overall)


class _NumCatFitted(Fitted):
    def __init__(self, stage, states, overall):
        super().__init__(stage)
        self.states, self.overall = states, overall

    def transform(self, df):
        out = df
        for cat, xs in self.stage.interactions.items():
            vals = {f"__gm_{x}": (f"__gm_{x}", F.lit(self.overall[x]).cast("double")) for x in xs}
            out = lookup(out, self.states[cat], cat, cat, vals)
            out = _add(out, {
                **{f"{x}_div_by_{cat}_mean": F.try_divide(num(x), F.col(f"__gm_{x}") + F.lit(EPS)) for x in xs},
                **{f"{x}_sub_by_{cat}_mean": num(x) - F.col(f"__gm_{x}") for x in xs}})
            out = out.drop(*[f"__gm_{x}" for x in xs])
        return out
