"""Group statistics (A1), rolling windows (A2) and the small aggregates the
encoders are built from (A3-A8)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import corrected_kurt, corrected_skew, num, ts_micros
from .base import COMBINED, Fitted, StatelessStage, Stage, require_columns
from .quantiles import grouped_quantiles
from .state import StateTable, attach

GROUP_FUNCS = ("mean", "std", "sum", "median", "min", "max", "count", "nunique", "skew", "kurt")


def _agg_exprs(value: str, func: str, out: str):
    """Aggregate expressions for one (value, func); pandas semantics."""
    v = num(value)
    if func == "mean":
        return [F.avg(v).alias(out)]
    if func == "std":
        return [F.stddev_samp(v).alias(out)]
    if func == "sum":  # an all-NULL group sums to 0, as in pandas
        return [F.coalesce(F.sum(v), F.lit(0.0)).alias(out)]
    if func == "min":
        return [F.min(v).alias(out)]
    if func == "max":
        return [F.max(v).alias(out)]
    if func == "count":
        return [F.count(v).alias(out)]
    if func == "nunique":
        return [F.count_distinct(v).alias(out)]
    if func == "skew":
        return [F.when(F.var_pop(v) == 0, F.lit(0.0))
                 .otherwise(corrected_skew(F.count(v), F.skewness(v))).alias(out)]
    if func == "kurt":
        return [F.when(F.var_pop(v) == 0, F.lit(0.0))
                 .otherwise(corrected_kurt(F.count(v), F.kurtosis(v))).alias(out)]
    raise ValueError(f"unsupported aggregate {func!r}; choose from {GROUP_FUNCS}")


class GroupStats(Stage):
    """A1: per key set, value × func statistics joined back onto each row.

    Output names: `<keys joined by _>_<func>_<value>`. Rows with a NULL key get
    NULL statistics. Decomposable statistics use map-side partial aggregation,
    so a hot key costs one partial row per task; the median uses the
    distributed rank method in `quantiles`."""

    fit_scope = COMBINED

    def __init__(self, name: str, group_keys, group_values, agg_funcs, approx_median: bool = False,
                 accuracy: int = 10_000):
        super().__init__(name)
        self.group_keys = list(group_keys)
        self.group_values = list(group_values)
        self.agg_funcs = list(agg_funcs)
        # scale option: a bounded-memory sketch per group instead of the exact rank method
        self.approx_median, self.accuracy = approx_median, accuracy
        for f in self.agg_funcs:
            if f not in GROUP_FUNCS:
                raise ValueError(f"unsupported aggregate {f!r}; choose from {GROUP_FUNCS}")

    def out_name(self, value, func):
        return f"{'_'.join(self.group_keys)}_{func}_{value}"

    def fit(self, df: DataFrame) -> Fitted:
        require_columns(df, self.group_keys + self.group_values, self.name)
        keys = self.group_keys
        src = df
        for k in keys:
            src = src.where(F.col(k).isNotNull())
        exprs = []
        for v in self.group_values:
            for f in self.agg_funcs:
                if f != "median":
                    exprs += _agg_exprs(v, f, self.out_name(v, f))
                elif self.approx_median:
                    exprs.append(F.percentile_approx(num(v), 0.5, self.accuracy).alias(self.out_name(v, f)))
        state = src.groupBy(*keys).agg(*exprs) if exprs else src.select(*keys).distinct()
        meds = []
        if "median" in self.agg_funcs and not self.approx_median:
            for v in self.group_values:
                meds.append(grouped_quantiles(src, v, [0.5], keys, [self.out_name(v, "median")]))
        for m in meds:
            state = state.join(m.df, on=keys, how="left")
        order = [self.out_name(v, f) for v in self.group_values for f in self.agg_funcs]
        st = StateTable.build(state.select(*keys, *order))
        for m in meds:
            m.df.unpersist()
        return _GroupStatsFitted(self, st)


class _GroupStatsFitted(Fitted):
    def __init__(self, stage, state: StateTable):
        super().__init__(stage)
        self.state = state

    def transform(self, df: DataFrame) -> DataFrame:
        return attach(df, self.state, self.stage.group_keys, "left")


_WINDOW_RE = re.compile(r"^\s*(\d+)\s*(D|d|h|H|min|T|s|S)\s*$")
_UNIT_US = {"D": 86_400_000_000, "d": 86_400_000_000, "h": 3_600_000_000, "H": 3_600_000_000,
            "min": 60_000_000, "T": 60_000_000, "s": 1_000_000, "S": 1_000_000}


def window_micros(spec: str) -> int:
    m = _WINDOW_RE.match(spec)
    if not m:
        raise ValueError(f"window size {spec!r}: expected forms like 3D, 12h, 30min, 45s")
    return int(m.group(1)) * _UNIT_US[m.group(2)]


class RollingStats(StatelessStage):
    """A2: per group, statistics over the time window (t-W, t] (rows sharing a
    timestamp are peers), lagged one row inside the group (ordered by time,
    then `order_col`) so a row only sees strictly earlier rows' windows.

    Linear in the rows: time is cut into blocks that divide W (of width W, or of
    at most `bucket`, to split a hot key further). A window is then the rest of
    one block, some whole blocks, and the beginning of the row's own block. The
    beginning is a running aggregate in time order; the rest comes from
    read-only copies of that block's rows, as a running aggregate in reverse
    order in which the block's own rows stand at the place t - W; whole blocks
    come from a small table with one row a block. The parts are merged, never
    subtracted, so no digits are lost. The one-row lag across block borders is
    resolved from a per-block "last value" table.

    Rows with a NULL key or date are not windowed; their features are NULL."""

    fit_scope = COMBINED
    FUNCS = ("mean", "sum", "count", "min", "max", "std")

    def __init__(self, name: str, group_keys, date_col: str, value_cols, window_sizes, agg_funcs,
                 order_col: str | None = None, bucket: str | None = None, transform_scope: str = "split"):
        super().__init__(name)
        # "split": train and test windows are computed separately (reference
        # behaviour); "combined": a feature-set build computes them over
        # train ∪ test, so test rows see the latest train history
        if transform_scope not in ("split", "combined"):
            raise ValueError("transform_scope must be 'split' or 'combined'")
        self.transform_scope = transform_scope
        self.group_keys = list(group_keys)
        self.date_col = date_col
        self.value_cols = list(value_cols)
        self.window_sizes = list(window_sizes)
        self.agg_funcs = list(agg_funcs)
        self.order_col = order_col
        for f in self.agg_funcs:
            if f not in self.FUNCS:
                raise ValueError(f"unsupported rolling aggregate {f!r}")
        self.bucket_us = window_micros(bucket) if bucket else None

    def out_name(self, value, window, func):
        return f"{'_'.join(self.group_keys)}_{value}_rolling_{window}_{func}"

    def _blocks(self, width: int) -> int:
        """Blocks a window: the fewest equal ones that are no wider than `bucket`."""
        n = -(-width // self.bucket_us) if self.bucket_us and self.bucket_us < width else 1
        while width % n:
            n += 1
        return n

    def _parts(self, v) -> list:
        """What one part of a window contributes, as (name, aggregate)."""
        out = [("n", F.count(v))]
        if {"sum", "mean"} & set(self.agg_funcs):
            out.append(("sum", F.sum(v)))
        if "std" in self.agg_funcs:
            out += [("mean", F.avg(v)), ("var", F.var_pop(v))]
        return out + [(f, {"min": F.min, "max": F.max}[f](v)) for f in ("min", "max") if f in self.agg_funcs]

    @staticmethod
    def _merge(x, y, names) -> dict:
        """Two parts as one (moments by the pairwise update)."""
        n = x["n"] + y["n"]
        out = {"n": n}
        if "sum" in names:
            out["sum"] = F.coalesce(x["sum"] + y["sum"], x["sum"], y["sum"])
        if "var" in names:
            d, share = y["mean"] - x["mean"], F.try_divide(y["n"], n)
            both = (x["n"] > 0) & (y["n"] > 0)
            out["mean"] = F.when(both, x["mean"] + d * share).otherwise(F.coalesce(x["mean"], y["mean"]))
            out["var"] = F.when(both, x["var"] + (y["var"] - x["var"]) * share + d * d * share * (1 - share)).otherwise(
                F.coalesce(x["var"], y["var"]))
        for f, pick in (("min", F.least), ("max", F.greatest)):
            if f in names:
                out[f] = pick(x[f], y[f])
        return out

    def _result(self, part, func):
        if func == "count":
            return part["n"]
        if func == "mean":
            return F.try_divide(part["sum"], part["n"])
        if func == "std":
            return F.when(part["n"] > 1, F.sqrt(part["var"] * part["n"] / (part["n"] - 1)))
        return part[func]

    def _whole_blocks(self, rows, block, names, count: int):
        """(keys..., block, whole): the parts of the `count` blocks before each
        block that has rows, merged; only those blocks that have rows exist."""
        keys, vals = self.group_keys, self.value_cols
        per = rows.groupBy(*keys, block).agg(*[
            F.struct(*[e.alias(n) for n, e in self._parts(num(v))]).alias(f"__w{i}") for i, v in enumerate(vals)])
        span = Window.partitionBy(*keys).orderBy(block).rangeBetween(-count, -1)

        def merged(i):
            kind = per.schema[f"__w{i}"].dataType
            none = F.struct(*[F.lit(0 if f.name == "n" else None).cast(f.dataType).alias(f.name) for f in kind])

            def step(x, y):
                m = self._merge({n: x[n] for n in names}, {n: y[n] for n in names}, names)
                return F.struct(*[m[f.name].cast(f.dataType).alias(f.name) for f in kind])

            return F.aggregate(F.collect_list(f"__w{i}").over(span), none, step)

        return per.select(*keys, block, *[merged(i).alias(f"__m{i}") for i in range(len(vals))])

    def _window(self, rows, width: int, window: str):
        """Add `__r_<feature>` of one window size to rows (with __t, in
        microseconds)."""
        keys, vals = self.group_keys, self.value_cols
        count = self._blocks(width)
        wide = width // count
        t, block = F.col("__t"), "__b"
        own = rows.withColumn(block, F.floor(t / F.lit(wide)).cast("long")).withColumn("__own", F.lit(True))
        copy = own.select(*keys, "__t", (F.col(block) + count).alias(block), F.lit(False).alias("__own"),
                          *[v for v in vals if v not in keys])
        both = own.unionByName(copy, allowMissingColumns=True)
        part = Window.partitionBy(*keys, block)
        begin = part.orderBy(F.when(F.col("__own"), t)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        # copies after t - W come first; of equal times, the row itself
        place = F.when(F.col("__own"), t - F.lit(width)).otherwise(t)
        rest = part.orderBy(place.desc(), F.col("__own").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        names, cols = [], []
        for i, v in enumerate(vals):
            mine, other = F.when(F.col("__own"), num(v)), F.when(~F.col("__own"), num(v))
            names = [n for n, _ in self._parts(mine)]
            cols += [e.over(begin).alias(f"__p{i}_{n}") for n, e in self._parts(mine)]
            cols += [e.over(rest).alias(f"__s{i}_{n}") for n, e in self._parts(other)]
        out = both.select("*", *cols).where("__own")
        if count > 1:
            out = out.join(self._whole_blocks(own, block, names, count - 1), [*keys, block])
        feats = []
        for i, v in enumerate(vals):
            m = self._merge({n: F.col(f"__s{i}_{n}") for n in names}, {n: F.col(f"__p{i}_{n}") for n in names}, names)
            if count > 1:
                m = self._merge({n: F.col(f"__m{i}")[n] for n in names}, m, names)
            feats += [self._result(m, f).alias("__r_" + self.out_name(v, window, f)) for f in self.agg_funcs]
        return out.select(*rows.columns, block, *feats)

    def apply(self, df: DataFrame) -> DataFrame:
        keys, oc = self.group_keys, self.order_col
        if oc is None:
            raise ValueError(f"{self.name}: order_col (a unique row id) is required to order ties")
        require_columns(df, keys + [self.date_col, oc] + self.value_cols, self.name)
        cols = df.columns
        base = df.withColumn("__t", ts_micros(self.date_col))
        known = F.col("__t").isNotNull()
        for k in keys:
            known = known & F.col(k).isNotNull()
        feats = [self.out_name(v, w, f) for v in self.value_cols for w in self.window_sizes for f in self.agg_funcs]
        rolled = base.where(known)
        for w in self.window_sizes:
            rolled = self._window(rolled.drop("__b"), window_micros(w), w)
        order = Window.partitionBy(*keys, "__b").orderBy("__t", oc)
        lagged = rolled.select("*", F.row_number().over(order).alias("__pos"),
                               *[F.lag("__r_" + n, 1).over(order).alias("__l_" + n) for n in feats])
        # last row of each (group, block): the lag source for the first row of
        # the next non-empty block of that group (small table)
        last = (rolled.groupBy(*keys, "__b")
                .agg(F.max_by(F.struct(*[F.col("__r_" + n).alias(n) for n in feats]),
                              F.struct("__t", oc)).alias("__last")))
        prev = (last.select(*keys, "__last",
                            F.lead("__b").over(Window.partitionBy(*keys).orderBy("__b")).alias("__b"))
                .where(F.col("__b").isNotNull()))
        joined = lagged.join(prev, on=[*keys, "__b"], how="left")
        out = joined.select(*cols, *[
            F.when(F.col("__pos") == 1, F.col("__last").getField(n)).otherwise(F.col("__l_" + n)).alias(n) for n in feats])
        types = {f.name: f.dataType for f in out.schema}
        rest = base.where(~known).select(*cols, *[F.lit(None).cast(types[n]).alias(n) for n in feats])
        return out.unionByName(rest)


# ---------------------------------------------------------------- A3 - A8


def value_counts(df: DataFrame, c: str, normalize: bool = False) -> DataFrame:
    """A3: count (or share of non-NULL rows) per category; NULLs excluded.
    The share's denominator is one scalar aggregate applied as a literal (no
    global window, which would pull a high-cardinality table into one task)."""
    g = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = df.where(F.col(c).isNotNull()).agg(F.count(F.lit(1))).first()[0]
        g = g.withColumn("share", F.col("count") / F.lit(float(max(total, 1))))
    return g


def top_n_categories(df: DataFrame, c: str, n: int) -> DataFrame:
    """A4: the N most frequent categories; ties by ascending value."""
    return value_counts(df, c).orderBy(F.desc("count"), F.asc(c)).limit(n)


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """A5: all non-NULL categories."""
    return df.select(c).where(F.col(c).isNotNull()).distinct()


def global_mean(df: DataFrame, c: str) -> DataFrame:
    """A7."""
    return df.agg(F.avg(num(c)).alias(f"{c}_mean"))


def min_max(df: DataFrame, cols) -> DataFrame:
    """One aggregate pass for the bounds of several columns."""
    exprs = []
    for c in cols:
        exprs += [F.min(num(c)).alias(f"{c}_min"), F.max(num(c)).alias(f"{c}_max")]
    return df.agg(*exprs)
